"""Gold layer: daily KPI summary (Q4) and per-user demographics (Q5).

The reference computes both from the silver sessions table, whose rows fan out: a
session appears once per login of its user that day. Its counts and means are therefore
weighted by the number of logins (and a repeated user id counts everything of that user
once per repetition). Materialising that fan-out costs sessions x logins rows per (user,
day), which explodes for a heavy user.

:func:`daily_summary` and :func:`user_demographics` give exactly the same numbers without
it. Sessions are pre-aggregated per (user, day, start hour) and logins per (user, day,
device). Joining those small cells gives each cell its weight (the login count, 1 when
there is none, times the user's rows in the user table, 1 when there is none). Both sides
collapse map-side before the shuffle, so a user holding a third of all rows ships a few
dozen rows per day. Purchases are weighted likewise, without reading user attributes.

:func:`daily_summary_from_silver` and :func:`user_demographics_from_silver` read a
materialised silver table instead, as the reference does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meeple.functions.exprs import (
    age_bracket,
    duration_minutes,
    half_up_mean,
    normalise_label,
    scaled_units,
    units_to_double,
)
from meeple.operators.topk import top_by_count
from meeple.plans.silver import earliest_login_per_day, valid_purchases
from meeple.sources.readers import day

DAILY_SUMMARY_COLUMNS = [
    "event_date",
    "total_sessions",
    "avg_session_duration",
    "unique_active_users",
    "total_revenue",
    "avg_purchase_amount",
    "top_device_type",
    "peak_hour",
]

# ----------------------------------------------------------------------- session cells


def repeated_users(users: DataFrame) -> DataFrame:
    """(user_id, copies) of the ids that the user table holds more than once: the joins of the
    silver tables repeat a row once per copy."""
    counted = users.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def _times_copies(cells: DataFrame, users: DataFrame | None, amounts: list[str]) -> DataFrame:
    """``cells`` with ``amounts`` multiplied by the number of the user's rows in the user table."""
    if users is None:
        return cells
    copies = F.coalesce(F.col("copies"), F.lit(1).cast("long"))
    joined = cells.join(repeated_users(users), "user_id", "left")
    return joined.select(*[(F.col(c) * copies).alias(c) if c in amounts else F.col(c) for c in cells.columns])


def login_cells(logins: DataFrame, weight: Column | None = None) -> DataFrame:
    """Logins counted (or weighed) per (user, day, normalised device)."""
    return logins.groupBy(
        "user_id", "event_date", normalise_label("device_type").alias("login_device")
    ).agg(F.sum(F.lit(1).cast("long") if weight is None else weight).alias("logins"))


def weighted_session_cells(
    sessions: DataFrame, logins: DataFrame, users: DataFrame | None, one_login_per_day: bool = False
) -> DataFrame:
    """Per (user, day, start hour, login device): the number of enriched session rows the
    reference's silver table holds (``n``), their duration total in tenths of a minute and
    the number of non-NULL durations, computed from the raw tables.

    A session matches every login of its user and day (weight = that device's login
    count), or none (weight 1, device NULL). NULL users and days never match. A user listed
    several times in ``users`` counts as often. With ``one_login_per_day`` a session matches
    the earliest login only, as in the silver table of that mode.
    """
    if one_login_per_day:
        logins = earliest_login_per_day(logins)
    return _times_copies(weighed(session_cells(sessions), login_cells(logins)), users, ["n", "dur_tenths", "n_dur"])


def session_cells(sessions: DataFrame, weight: Column | None = None) -> DataFrame:
    """Sessions counted per (user, day, start hour), with their duration total in tenths of a minute
    and the number of non-NULL durations. ``weight``: what a row counts (1, or -1 for a row that goes)."""
    minutes = duration_minutes("start_time", "end_time")
    w = F.lit(1).cast("long") if weight is None else weight
    return sessions.groupBy("user_id", "event_date", F.hour("start_time").alias("hour")).agg(
        F.sum(w).alias("s_n"),
        F.sum((minutes * 10).cast("long") * w).alias("s_dur"),
        F.sum(minutes.isNotNull().cast("long") * w).alias("s_ndur"),
    )


def weighed(cells: DataFrame, logins: DataFrame) -> DataFrame:
    """Session cells by login device, each counted as often as that device's logins of the user and
    day (once, with a NULL device, without any)."""
    joined = cells.join(logins, ["user_id", "event_date"], "left")
    weight = F.coalesce(F.col("logins"), F.lit(1).cast("long"))
    return joined.select(
        "user_id",
        "event_date",
        "hour",
        "login_device",
        (F.col("s_n") * weight).alias("n"),
        (F.col("s_dur") * weight).alias("dur_tenths"),
        (F.col("s_ndur") * weight).alias("n_dur"),
    )


def purchase_cells(purchases: DataFrame, users: DataFrame | None, weight: Column | None = None) -> DataFrame:
    """Per (user, day): spend in cents and number of the silver purchases, from the raw
    purchases (no user attribute is read)."""
    w = F.lit(1).cast("long") if weight is None else weight
    cells = valid_purchases(purchases).groupBy("user_id", "event_date").agg(
        F.sum(scaled_units("amount", 2) * w).alias("spent_cents"), F.sum(w).alias("purchases")
    )
    return _times_copies(cells, users, ["spent_cents", "purchases"])


def silver_purchase_cells(silver_purchases: DataFrame) -> DataFrame:
    """The same columns read off a materialised silver purchases table (one per row)."""
    return silver_purchases.select(
        "user_id", "event_date", scaled_units("amount", 2).alias("spent_cents"),
        F.col("amount").isNotNull().cast("long").alias("purchases"),
    )


def silver_session_cells(silver_sessions: DataFrame) -> DataFrame:
    """The same cells read off a materialised silver sessions table (one per row)."""
    return silver_sessions.select(
        "user_id",
        "event_date",
        F.hour("start_time").alias("hour"),
        "login_device",
        F.lit(1).cast("long").alias("n"),
        scaled_units("session_duration_minutes", 1).alias("dur_tenths"),
        F.col("session_duration_minutes").isNotNull().cast("long").alias("n_dur"),
    )


# ----------------------------------------------------------------------- daily summary


def _most_then_smallest(count_col: str, value_col: str) -> Column:
    """Sort key for ``min_by``: highest count first, then the smaller value, NULL last."""
    return F.struct(-F.col(count_col), F.col(value_col).isNull(), F.col(value_col))


def _summary(cells: DataFrame, bought: DataFrame) -> DataFrame:
    """The daily summary from session cells (their users are the day's distinct users) and
    purchase cells."""
    users = cells.groupBy("event_date").agg(F.count_distinct("user_id").alias("unique_active_users"))
    return summary_of_days(day_cells(cells), users, day_revenue(bought))


def day_cells(cells: DataFrame) -> DataFrame:
    """Session cells per (day, hour, device): at most days x 24 x devices rows, combined map-side."""
    return cells.groupBy("event_date", "hour", "login_device").agg(
        F.sum("n").alias("n"), F.sum("dur_tenths").alias("dur_tenths"), F.sum("n_dur").alias("n_dur")
    )


def summary_of_days(per_cell: DataFrame, users: DataFrame, revenue: DataFrame) -> DataFrame:
    """The daily summary from :func:`day_cells`, distinct users and :func:`day_revenue` by day."""
    # One branch over those cells: window sums give each cell its hour's and its device's
    # count for the day, then one aggregate per day picks the winners. The cells are
    # shuffled by day once; the windows and the aggregate reuse that partitioning.
    ranked = per_cell.repartition("event_date").select(
        "*",
        F.sum("n").over(Window.partitionBy("event_date", "hour")).alias("hour_n"),
        F.sum("n").over(Window.partitionBy("event_date", "login_device")).alias("device_n"),
    )
    per_day = ranked.groupBy("event_date").agg(
        F.sum("n").alias("total_sessions"),
        half_up_mean(F.sum("dur_tenths"), F.sum("n_dur"), 1).alias("avg_session_duration"),
        F.min_by("hour", _most_then_smallest("hour_n", "hour")).alias("peak_hour"),
        F.min_by("login_device", _most_then_smallest("device_n", "login_device")).alias(
            "top_device_type"
        ),
    )
    out = per_day.join(users, "event_date").join(_revenue_columns(revenue), "event_date", "left")
    return out.select(*DAILY_SUMMARY_COLUMNS)


def daily_revenue(purchases: DataFrame) -> DataFrame:
    """Per day with silver purchases: total revenue and mean purchase (exact cents, half-up)."""
    return _revenue_columns(day_revenue(silver_purchase_cells(purchases)))


def day_revenue(bought: DataFrame) -> DataFrame:
    """Cents and purchases by day."""
    return bought.groupBy("event_date").agg(F.sum("spent_cents").alias("cents"), F.sum("purchases").alias("n_buy"))


def _revenue_columns(revenue: DataFrame) -> DataFrame:
    return revenue.select(
        "event_date",
        units_to_double("cents", 2).alias("total_revenue"),
        half_up_mean("cents", "n_buy", 2).alias("avg_purchase_amount"),
    )


def daily_summary(
    sessions: DataFrame,
    logins: DataFrame,
    purchases: DataFrame,
    users: DataFrame,
    run_date: dt.date | str | None = None,
    one_login_per_day: bool = False,
) -> DataFrame:
    """Q4: per day, sessions, mean duration, active users, revenue, top device, peak hour.

    All four are raw tables; of ``users`` only the ids that occur more than once matter.
    With ``run_date`` only that day is computed (the daily job); without it, every day
    (backfill). Both give identical rows, and the same rows as the reference computes
    from its silver table:

    * sessions are counted as enriched rows (a session counts once per login of its user
      that day), the mean duration is over those rows (2 decimals, half-up);
    * distinct users ignore NULL; a day without sessions has no row even with revenue; a
      day without purchases has NULL revenue;
    * the reference's top-1 queries had no tie-break; here ties go to the earlier hour
      and to the smaller device label, NULL (no login) last.
    """
    if run_date is not None:
        sessions, logins, purchases = (day(t, run_date) for t in (sessions, logins, purchases))
    cells = weighted_session_cells(sessions, logins, users, one_login_per_day)
    return _summary(cells, purchase_cells(purchases, users))


def daily_summary_from_silver(
    silver_sessions: DataFrame, purchases: DataFrame, run_date: dt.date | str | None = None
) -> DataFrame:
    """Q4 read off materialised silver tables (one count per silver row), as the reference."""
    if run_date is not None:
        silver_sessions, purchases = day(silver_sessions, run_date), day(purchases, run_date)
    return _summary(silver_session_cells(silver_sessions), silver_purchase_cells(purchases))


def daily_summary_from_cells(
    cells: DataFrame, bought: DataFrame, run_date: dt.date | str | None = None
) -> DataFrame:
    """Q4 from stored :func:`weighted_session_cells` and purchase cells: the daily job computes
    the cells once per day and reads them for both the summary and the per-user metrics."""
    if run_date is not None:
        cells, bought = day(cells, run_date), day(bought, run_date)
    return _summary(cells, bought)


def top_per_day(sessions: DataFrame, value: Column, name: str) -> DataFrame:
    """The most frequent ``value`` of each day's sessions (ties: smaller, NULL last),
    as a top-1-per-group window over the per-(day, value) counts."""
    counts = sessions.groupBy("event_date", value.alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
    return top_by_count(counts, ["event_date"], name).select("event_date", name, "cnt")


# -------------------------------------------------------------------------- demographics


def _session_metrics(cells: DataFrame) -> DataFrame:
    return cells.groupBy("user_id").agg(
        F.sum("n").alias("total_sessions"),
        half_up_mean(F.sum("dur_tenths"), F.sum("n_dur"), 1).alias("avg_session_duration"),
    )


def session_metrics(sessions: DataFrame, logins: DataFrame, users: DataFrame) -> DataFrame:
    """Per user: enriched session rows and their mean duration (2 decimals, half-up)."""
    return _session_metrics(weighted_session_cells(sessions, logins, users))


def purchase_metrics(purchases: DataFrame) -> DataFrame:
    """Per user of the silver purchases: total spent (exact cents) and number of purchases."""
    return purchases.groupBy("user_id").agg(
        units_to_double(F.sum(scaled_units("amount", 2)), 2).alias("total_spent"),
        F.count(F.lit(1)).alias("num_purchases"),
    )


def _demographics_of_cells(users: DataFrame, cells: DataFrame, bought: DataFrame, copies: DataFrame | None) -> DataFrame:
    """Users joined to their sums. ``copies``: (user_id, copies) by which the sums still have to be
    multiplied; the mean duration and nothing else is unchanged by it."""
    sessions = cells.groupBy("user_id").agg(
        F.sum("n").alias("n"), half_up_mean(F.sum("dur_tenths"), F.sum("n_dur"), 1).alias("avg_session_duration")
    )
    spent = bought.groupBy("user_id").agg(F.sum("spent_cents").alias("cents"), F.sum("purchases").alias("purchases"))
    joined = users.join(sessions, "user_id", "left").join(spent, "user_id", "left")
    times = F.lit(1).cast("long")
    if copies is not None:
        joined = joined.join(copies, "user_id", "left")
        times = F.coalesce(F.col("copies"), times)
    return _demographic_columns(
        joined.withColumns({
            "total_sessions": F.col("n") * times, "total_spent": units_to_double(F.col("cents") * times, 2),
            "num_purchases": F.col("purchases") * times,
        })
    )


def _demographic_columns(joined: DataFrame) -> DataFrame:
    """The published demographics columns of users left-joined to their metrics."""
    return joined.select(
        "user_id",
        "gender",
        age_bracket("age").alias("age_bracket"),
        "country",
        F.col("signup_date").alias("registration_date"),
        F.coalesce("total_sessions", F.lit(0).cast("long")).alias("total_sessions"),
        F.coalesce("avg_session_duration", F.lit(0.0)).alias("avg_session_duration"),
        F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"),
        F.coalesce("num_purchases", F.lit(0).cast("long")).alias("num_purchases"),
    )


def _demographics(users: DataFrame, metrics: DataFrame, purchases: DataFrame) -> DataFrame:
    joined = users.join(metrics, "user_id", "left").join(purchase_metrics(purchases), "user_id", "left")
    return _demographic_columns(joined)


def user_demographics(
    users: DataFrame, sessions: DataFrame, logins: DataFrame, purchases: DataFrame
) -> DataFrame:
    """Q5: every user with age bracket, activity and spend (zeros when none).

    All four are raw tables. Session metrics equal the reference's (counted over enriched
    rows). Both sides are aggregated per user before the joins (joining first would multiply
    the two fan-outs); the copies of repeated ids are multiplied in at the end.
    """
    return _demographics_of_cells(
        users, weighted_session_cells(sessions, logins, None), purchase_cells(purchases, None), repeated_users(users)
    )


def user_day_metrics(sessions: DataFrame, logins: DataFrame, purchases: DataFrame, users: DataFrame) -> DataFrame:
    """Per (user, day): enriched session rows, duration total (tenths) and count, spend
    (cents) and purchases. Every field is an integer sum, so any set of days adds up to
    exactly the all-history figures; the daily job appends one partition per day and the
    demographics never rescan raw history.

    All four are raw tables.
    """
    return user_day_metrics_from_cells(weighted_session_cells(sessions, logins, users), purchase_cells(purchases, users))


def user_day_metrics_from_cells(cells: DataFrame, bought: DataFrame) -> DataFrame:
    """:func:`user_day_metrics` from stored session cells and purchase cells."""
    cells = cells.groupBy("user_id", "event_date").agg(
        F.sum("n").alias("sessions"),
        F.sum("dur_tenths").alias("dur_tenths"),
        F.sum("n_dur").alias("n_dur"),
    )
    both = cells.join(bought, ["user_id", "event_date"], "full_outer")
    zero = F.lit(0).cast("long")
    return both.select(
        "user_id",
        "event_date",
        F.coalesce("sessions", zero).alias("sessions"),
        "dur_tenths",
        F.coalesce("n_dur", zero).alias("n_dur"),
        "spent_cents",
        F.coalesce("purchases", zero).alias("purchases"),
    )


def user_demographics_from_daily(users: DataFrame, daily: DataFrame) -> DataFrame:
    """Q5 from the per-(user, day) metrics table: the same rows as
    :func:`user_demographics` over the same days."""
    per_user = daily.groupBy("user_id").agg(
        F.sum("sessions").alias("s"),
        F.sum("dur_tenths").alias("d"),
        F.sum("n_dur").alias("nd"),
        F.sum("spent_cents").alias("c"),
        F.sum("purchases").alias("p"),
    )
    metrics = per_user.select(
        "user_id",
        F.when(F.col("s") > 0, F.col("s")).alias("total_sessions"),
        half_up_mean("d", "nd", 1).alias("avg_session_duration"),
        F.when(F.col("p") > 0, units_to_double("c", 2)).alias("total_spent"),
        F.when(F.col("p") > 0, F.col("p")).alias("num_purchases"),
    )
    return _demographic_columns(users.join(metrics, "user_id", "left"))


def user_demographics_from_silver(
    users: DataFrame, silver_sessions: DataFrame, purchases: DataFrame
) -> DataFrame:
    """Q5 read off materialised silver tables, as the reference. The per-user aggregates
    come out hash-partitioned by ``user_id``, which the joins reuse."""
    return _demographics(users, _session_metrics(silver_session_cells(silver_sessions)), purchases)
