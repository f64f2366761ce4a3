"""Gold kept up by change feeds (S17 -> Q4, Q5): old gold and the rows that changed give new gold.

The raw tables are never read again. A state of counts stands between them and gold:

* ``sessions``, ``logins``, ``purchases``: the cells of :mod:`meeple.plans.gold` per (user, day);
  ``copies``: how often the user table lists a user;
* ``cells`` per (day, hour, device), ``actives`` (distinct users per day), ``revenue`` per day and
  ``totals`` per user: what the summary and the demographics are made of.

Everything is a sum or a multiplicity, so a row that goes is a row that comes with weight -1. A feed
becomes signed cells; the (user, day) keys it touches are weighed with the old and with the new
counts, and the difference is added to the derived tables. Distinct users shrink when a
user's last row of a day goes, and a day's winners are picked again from its cells.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meeple.operators import tables
from meeple.operators.tables import WEIGHT
from meeple.plans import gold

KEY = ["user_id", "event_date"]


@dataclass(frozen=True)
class GoldState:
    sessions: DataFrame  # user_id, event_date, hour, s_n, s_dur, s_ndur
    logins: DataFrame  # user_id, event_date, login_device, logins
    purchases: DataFrame  # user_id, event_date, spent_cents, purchases
    copies: DataFrame  # user_id, copies
    cells: DataFrame  # event_date, hour, login_device, n, dur_tenths, n_dur
    actives: DataFrame  # event_date, unique_active_users
    revenue: DataFrame  # event_date, cents, n_buy
    totals: DataFrame  # user_id, n, dur_tenths, n_dur, cents, n_buy

    def map(self, function) -> GoldState:
        return GoldState(*[function(getattr(self, f.name)) for f in fields(self)])


def _no_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in columns})


def _copies(users: DataFrame, weight: Column) -> DataFrame:
    return users.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.sum(weight).alias("copies"))


def _weighed(sessions: DataFrame, logins: DataFrame, purchases: DataFrame, copies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Session cells and purchase cells as the summary counts them: times logins, times copies."""
    times = F.greatest(F.coalesce("copies", F.lit(1).cast("long")), F.lit(1).cast("long"))
    seen = gold.weighed(sessions, logins).join(copies, "user_id", "left")
    bought = purchases.join(copies, "user_id", "left")
    return (
        seen.select(*KEY, "hour", "login_device", *[(F.col(c) * times).alias(c) for c in ("n", "dur_tenths", "n_dur")]),
        bought.select(*KEY, (F.col("spent_cents") * times).alias("spent_cents"), (F.col("purchases") * times).alias("purchases")),
    )


def _derived(seen: DataFrame, bought: DataFrame, sign: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """cells, actives, revenue, totals of weighed cells, times ``sign``."""
    s = F.lit(sign).cast("long")
    cells = gold.day_cells(seen)
    actives = seen.filter("user_id IS NOT NULL").select(*KEY).distinct().groupBy("event_date").agg(F.count(F.lit(1)).alias("unique_active_users"))
    revenue = gold.day_revenue(bought)
    zero = F.lit(0).cast("long")
    totals = (
        seen.select("user_id", "n", "dur_tenths", "n_dur", zero.alias("cents"), zero.alias("n_buy"))
        .unionByName(bought.select("user_id", zero.alias("n"), zero.alias("dur_tenths"), zero.alias("n_dur"), F.col("spent_cents").alias("cents"), F.col("purchases").alias("n_buy")))
        .groupBy("user_id").agg(*[F.sum(c).alias(c) for c in ("n", "dur_tenths", "n_dur", "cents", "n_buy")])
    )
    out = []
    for df, keys in ((cells, 3), (actives, 1), (revenue, 1), (totals, 1)):
        out.append(df.select(*df.columns[:keys], *[(F.coalesce(F.col(c), zero) * s).alias(c) for c in df.columns[keys:]]))
    return tuple(out)


def state_of(sessions: DataFrame, logins: DataFrame, purchases: DataFrame, users: DataFrame) -> GoldState:
    """The state of raw tables (the first run, or a rebuild)."""
    one = F.lit(1).cast("long")
    seen = _no_nulls(gold.session_cells(sessions), ["s_dur", "s_ndur"])
    logged, bought, copies = gold.login_cells(logins), gold.purchase_cells(purchases, None), _copies(users, one)
    return GoldState(seen, logged, bought, copies, *_derived(*_weighed(seen, logged, bought, copies), 1))


def _added(old: DataFrame, change: DataFrame, keys: int, *presence: str) -> DataFrame:
    """Sums of both by the first ``keys`` columns; what is left with 0 in all of ``presence`` is gone."""
    names, values = old.columns[:keys], old.columns[keys:]
    both = old.unionByName(change.select(*old.columns)).groupBy(*names).agg(*[F.sum(c).alias(c) for c in values])
    return both.filter(" OR ".join(f"{c} <> 0" for c in presence))


def _at(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` under the (user, day) ``keys``; NULLs match."""
    d, k = df.alias("d"), keys.alias("k")
    same = F.col("d.user_id").eqNullSafe(F.col("k.user_id")) & F.col("d.event_date").eqNullSafe(F.col("k.event_date"))
    return d.join(k, same, "left_semi")


def advance(
    state: GoldState, sessions: DataFrame, logins: DataFrame, purchases: DataFrame, users: DataFrame
) -> tuple[GoldState, DataFrame]:
    """The state after four feeds (raw rows with ``_weight``, see :func:`tables.signed`,
    :func:`tables.bag_changes`), and the (event_date) of the days whose gold row may differ.

    Reads the feeds and the state only; of the per-user cells, what the touched keys select is
    weighed again. A feed that takes away what is not there gives counts that no table has: build
    feeds against the version that the state is of."""
    new_seen = _no_nulls(gold.session_cells(sessions, F.col(WEIGHT)), ["s_dur", "s_ndur"])
    new_logged = gold.login_cells(logins, F.col(WEIGHT))
    new_bought = gold.purchase_cells(purchases, None, F.col(WEIGHT))
    new_copies = _copies(users, F.col(WEIGHT)).filter("copies <> 0")

    seen = _added(state.sessions, new_seen, 3, "s_n")
    logged = _added(state.logins, new_logged, 3, "logins")
    bought = _added(state.purchases, new_bought, 2, "purchases")
    copies = _added(state.copies, new_copies, 1, "copies")

    relisted = state.sessions.select(*KEY).unionByName(state.purchases.select(*KEY)).join(new_copies.select("user_id"), "user_id", "left_semi")
    touched = tables.stage(
        new_seen.select(*KEY).unionByName(new_logged.select(*KEY)).unionByName(new_bought.select(*KEY)).unionByName(relisted.select(*KEY)).distinct()
    )
    before = _weighed(_at(state.sessions, touched), _at(state.logins, touched), _at(state.purchases, touched), state.copies)
    after = _weighed(_at(seen, touched), _at(logged, touched), _at(bought, touched), copies)
    changes = [
        plus.unionByName(minus) for plus, minus in zip(_derived(*after, 1), _derived(*before, -1))
    ]
    cells = _added(state.cells, changes[0], 3, "n")
    actives = _added(state.actives, changes[1], 1, "unique_active_users")
    revenue = _added(state.revenue, changes[2], 1, "n_buy")
    totals = _added(state.totals, changes[3], 1, "n", "n_buy")
    return GoldState(seen, logged, bought, copies, cells, actives, revenue, totals), touched.select("event_date").distinct()


def summary(state: GoldState, days: DataFrame | None = None) -> DataFrame:
    """Q4 from the state; with ``days`` (event_date), of those days only."""
    parts = [state.cells, state.actives, state.revenue]
    if days is not None:
        parts = [p.join(days, "event_date", "left_semi") for p in parts]
    cells, actives, revenue = parts
    # a day with sessions of unknown users only has no distinct user, but a row
    known = cells.select("event_date").distinct().join(actives, "event_date", "left")
    return gold.summary_of_days(cells, _no_nulls(known, ["unique_active_users"]), revenue)


def advance_summary(old_gold: DataFrame, state: GoldState, days: DataFrame) -> DataFrame:
    """New gold: the old rows of the other days, and the touched days' rows from the new state."""
    return old_gold.join(days, "event_date", "left_anti").unionByName(summary(state, days).select(*old_gold.columns))


def demographics(users: DataFrame, state: GoldState) -> DataFrame:
    """Q5 from the state's totals."""
    daily = state.totals.select(
        "user_id", F.col("n").alias("sessions"), "dur_tenths", "n_dur", F.col("cents").alias("spent_cents"), F.col("n_buy").alias("purchases")
    )
    return gold.user_demographics_from_daily(users, daily)
