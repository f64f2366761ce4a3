"""Player segmentation in whole numbers (M2-M12, Q6-Q8): K-means whose result SQL can compute.

Spark ML's K-means sums doubles and draws its starting points by partition and row. Here every step
is exact, so segments depend on the users alone, not on row order, partitions or engine:

* features are integers (sessions, hundredths of minutes, cents, purchases); their sums and sums of
  squares give the scaler, and a standardised feature is an integer of ``1 / SCALE`` deviations;
* the start is a farthest-point walk over the distinct users of least hash (``CANDIDATES``);
* a Lloyd round is one aggregate of integer sums over the distinct feature vectors and their
  counts, for any number of models at once; centres are rounded quotients;
* the silhouette comes from each cluster's count, sum and sum of squares.

Only models reach the driver: sums by feature, centres, candidates. The rounds read a stored table of
distinct vectors, which partial aggregation collapses before its one shuffle.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.functions.exprs import scaled_units
from meeple.operators import tables
from meeple.plans.segments import (
    CASUAL, DEFAULT_K, FEATURES, INACTIVE, RATE_RULE_MIN_RATE, SCORE_MIN_MINUTES, SEGMENT_COLUMNS, TRAIN_MIN_MINUTES,
    cluster_label_map, cluster_profile, inactive_condition, label_clusters, split_inactive, tag, with_account_age,
)

#: A standardised feature counts so many to the deviation.
SCALE = 1000
#: Deviations are kept to this part of a feature's unit.
DEVIATION_PARTS = 1000
ROUNDS = 20
#: Distinct feature vectors, those of least hash, that starting points are chosen from.
CANDIDATES = 1000
#: Distinct feature vectors that one task of a round works through.
POINTS_PER_TASK = 1 << 18

_X = ["x0", "x1", "x2", "x3"]
_Q = ["q0", "q1", "q2", "q3"]
_DEC = "decimal(38,0)"
Centre = tuple[int, ...]


# --- features ---------------------------------------------------------------------------------


def unit_features() -> list[Column]:
    """The features as BIGINTs: sessions, hundredths of minutes, cents, purchases."""
    sessions, minutes, spent, bought = FEATURES
    return [
        F.col(sessions).cast("long").alias("x0"), scaled_units(minutes, 2).alias("x1"),
        scaled_units(spent, 2).alias("x2"), F.col(bought).cast("long").alias("x3"),
    ]


@dataclass(frozen=True)
class Scaler:
    """Number of users, and each feature's sum and sum of squares."""

    n: int
    sums: Centre
    squares: Centre

    def deviations(self) -> list[int]:
        """Sample deviations in 1 / DEVIATION_PARTS of a feature's unit, rounded down."""
        if self.n < 2:
            return [0] * len(self.sums)
        return [
            math.isqrt(DEVIATION_PARTS**2 * (self.n * t - s * s) // (self.n * (self.n - 1)))
            for s, t in zip(self.sums, self.squares)
        ]

    def columns(self, units: list[Column]) -> list[Column]:
        """(x - mean) / deviation in 1 / SCALE, rounded down; 0 for a constant feature."""
        out = []
        for x, s, d, name in zip(units, self.sums, self.deviations(), _Q):
            if d == 0:
                out.append(F.lit(0).cast("long").alias(name))
                continue
            part = (x.cast(_DEC) * _whole(self.n) - _whole(s)) * _whole(SCALE * DEVIATION_PARTS)
            out.append(_floor_div(part, _whole(self.n * d)).cast("long").alias(name))
        return out


def _whole(n: int) -> Column:
    return F.lit(Decimal(n)).cast(_DEC)


def _floor_div(a: Column, b: Column) -> Column:
    """Floor of a / b for whole decimals, b > 0 (the division is of an exact multiple)."""
    return (a - F.pmod(a, b)) / b


def points_of(active: DataFrame) -> DataFrame:
    """Distinct feature vectors (x0..x3) and the number of users of each (w)."""
    return active.select(*unit_features()).groupBy(*_X).agg(F.count(F.lit(1)).alias("w"))


def fit_scaler(points: DataFrame) -> Scaler:
    row = points.agg(
        F.sum("w").alias("n"),
        *[F.sum(F.col(x).cast(_DEC) * F.col("w")).alias(f"s_{x}") for x in _X],
        *[F.sum(F.col(x).cast("decimal(19,0)") * F.col(x).cast("decimal(19,0)") * F.col("w")).cast(_DEC).alias(f"t_{x}") for x in _X],
    ).first()
    return Scaler(int(row["n"] or 0), tuple(int(row[f"s_{x}"] or 0) for x in _X), tuple(int(row[f"t_{x}"] or 0) for x in _X))


# --- models -----------------------------------------------------------------------------------


def starting_points(points: DataFrame, k: int, candidates: int = CANDIDATES) -> list[Centre]:
    """Up to ``k`` different points: the candidate of least hash, then always the one farthest from
    those chosen (ties: the smaller hash). ``points`` have x0..x3 and q0..q3."""
    order = [F.md5(F.concat_ws("|", *_X)), *_X]
    rows = [tuple(r) for r in points.orderBy(*order).limit(candidates).select(*_Q).collect()]
    chosen, away = [], [math.inf] * len(rows)
    while rows and len(chosen) < k:
        best = max(range(len(rows)), key=lambda i: (away[i], -i))
        if away[best] == 0:
            break
        chosen.append(rows[best])
        away = [min(d, sum((a - b) ** 2 for a, b in zip(r, chosen[-1]))) for d, r in zip(away, rows)]
    return chosen


def _numbers(values: Iterable[int | None], kind: str = "bigint") -> str:
    """An array literal as SQL text. The plan refers to it as data, so that rounds share their code."""
    return "array(" + ", ".join("NULL" if v is None else f"CAST('{v}' AS {kind})" for v in values) + ")"


def _nearest(centres: str, k: int) -> str:
    """SQL text: place of the nearest of ``k`` centres, whose components stand one after another in an
    array (it may end before), by squared distance; ties: the first."""
    away = lambda i, j: f"({_Q[j]} - get({centres}, {len(_Q) * i + j}))"
    distances = ", ".join(" + ".join(f"{away(i, j)} * {away(i, j)}" for j in range(len(_Q))) for i in range(k))
    return f"CAST(array_position(array({distances}), array_min(array({distances}))) - 1 AS INT)"


def _assigned(points: DataFrame, models: dict[int, list[Centre]], more: dict[str, dict[int, str]] | None = None) -> DataFrame:
    """A row for each point and model: k, cluster, and columns ``more`` (name -> k -> literal)."""
    most = max(map(len, models.values()))
    rows = [
        ", ".join([f"struct({k} AS k", f"{_numbers(v for c in centres for v in c)} AS centres", *[f"{x[k]} AS {n}" for n, x in (more or {}).items()]]) + ")"
        for k, centres in models.items()
    ]
    each = points.select("*", F.expr(f"inline(array({', '.join(rows)}))"))
    return each.withColumn("cluster", F.expr(_nearest("centres", most))).drop("centres")


def _sums(points: DataFrame, models: dict[int, list[Centre]], squares: bool = False) -> dict[tuple[int, int], tuple[int, ...]]:
    """By (k, cluster): users, sums of q0..q3 and, if asked for, the sum of squared lengths."""
    total = lambda x, name: f"sum(CAST({x} AS {_DEC}) * w) AS {name}"
    wanted = ["sum(w) AS n", *[total(q, q) for q in _Q]] + [total(" + ".join(f"{q} * {q}" for q in _Q), "t")] * squares
    rows = _assigned(points, models).groupBy("k", "cluster").agg(*map(F.expr, wanted))
    return {(r["k"], r["cluster"]): tuple(int(v) for v in r[2:]) for r in rows.collect()}


def lloyd(points: DataFrame, starts: dict[int, list[Centre]], rounds: int = ROUNDS) -> dict[int, list[Centre]]:
    """Centres of several models (by k) after up to ``rounds`` rounds, one aggregate a round for all;
    it ends when no centre moves. An empty cluster keeps its centre."""
    models = dict(starts)
    for _ in range(rounds):
        sums = _sums(points, models)
        moved = {
            k: [
                tuple((2 * s + own[0]) // (2 * own[0]) for s in own[1:]) if (own := sums.get((k, i))) else centre
                for i, centre in enumerate(centres)
            ]
            for k, centres in models.items()
        }
        if moved == models:
            break
        models = moved
    return models


@dataclass(frozen=True)
class ExactModel:
    """A fitted segmentation: the scaler and the centres in its scale."""

    scaler: Scaler
    centres: list[Centre]
    #: Segment of each cluster, as labelled in training; scoring one user needs no other then.
    labels: tuple[str, ...] = ()

    def cluster(self, users: DataFrame, scaler: Scaler | None = None) -> DataFrame:
        """``users`` with their ``cluster``, under the model's scaler or another."""
        nearest = _nearest(_numbers(v for c in self.centres for v in c), len(self.centres))
        return _with_features(users, scaler or self.scaler).withColumn("cluster", F.expr(nearest)).drop(*_Q)

    def to_json(self) -> str:
        return json.dumps({"n": self.scaler.n, "sums": self.scaler.sums, "squares": self.scaler.squares, "centres": self.centres, "labels": self.labels})

    @classmethod
    def from_json(cls, text: str) -> ExactModel:
        d = json.loads(text)
        return cls(Scaler(d["n"], tuple(d["sums"]), tuple(d["squares"])), [tuple(c) for c in d["centres"]], tuple(d.get("labels", ())))


def _with_features(users: DataFrame, scaler: Scaler) -> DataFrame:
    return users.select("*", *scaler.columns(unit_features()))


def prepared(active: DataFrame) -> tuple[DataFrame, Scaler]:
    """The stored points of ``active`` with standardised features, and their scaler. They come in as
    many partitions as they are worth, so a round over few of them is one task without a shuffle."""
    raw = tables.stage(points_of(active))
    scaler = fit_scaler(raw)
    points = tables.stage(raw.select("*", *scaler.columns([F.col(x) for x in _X])))
    return points.coalesce(max(1, -(-points.count() // POINTS_PER_TASK))), scaler


def fit(active: DataFrame, k: int = DEFAULT_K, rounds: int = ROUNDS) -> ExactModel:
    """K-means on the active users. With fewer different users than ``k``, fewer clusters; with
    none, a model without centres."""
    points, scaler = prepared(active)
    start = starting_points(points, k)
    return ExactModel(scaler, lloyd(points, {k: start}, rounds)[k] if start else [])


# --- jobs -------------------------------------------------------------------------------------


def _finish(active: DataFrame, inactive: DataFrame, model: ExactModel, scaler: Scaler | None = None) -> DataFrame:
    if not model.centres:
        return tag(active, INACTIVE).unionByName(tag(inactive, INACTIVE)).filter(F.col("user_segment").isNotNull())
    clustered = label_clusters(model.cluster(active, scaler)).drop("cluster")
    return clustered.unionByName(tag(inactive, INACTIVE))


def train_segments(
    demographics: DataFrame, as_of: dt.date | str, k: int = DEFAULT_K, min_rate: float = RATE_RULE_MIN_RATE,
    min_minutes: float = TRAIN_MIN_MINUTES, rule: str = "rate",
) -> tuple[DataFrame, ExactModel]:
    """Q6/M7: split off the inactive users, fit on the others, label, union. Columns as
    :func:`meeple.plans.segments.train_segments`."""
    users = tables.stage(with_account_age(demographics, as_of))
    active, inactive = split_inactive(users, inactive_condition(rule, min_rate, min_minutes))
    model = fit(active, k)
    if model.centres:
        named = cluster_label_map(cluster_profile(model.cluster(active))).select("cluster", "user_segment").collect()  # k rows
        of = {r["cluster"]: r["user_segment"] for r in named}
        model = ExactModel(model.scaler, model.centres, tuple(of.get(i, CASUAL) for i in range(len(model.centres))))
    return _finish(active, inactive, model), model


def score_segments(
    demographics: DataFrame, as_of: dt.date | str, model: ExactModel, refit_scaler: bool = False,
    min_rate: float = RATE_RULE_MIN_RATE, min_minutes: float = SCORE_MIN_MINUTES,
) -> DataFrame:
    """Q7/M8: segment users with a saved model; ``refit_scaler`` standardises by the day's active
    users, as the reference does, else by those of the training."""
    users = tables.stage(with_account_age(demographics, as_of))
    active, inactive = split_inactive(users, inactive_condition("rate", min_rate, min_minutes))
    return _finish(active, inactive, model, fit_scaler(points_of(active)) if refit_scaler else None)


def simple_segments(gold_demographics: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Segment a gold demographics table again with the ``simple`` rule; 9 columns."""
    base = tables.stage(gold_demographics.select(*SEGMENT_COLUMNS[:-1]))
    active, inactive = split_inactive(base, inactive_condition("simple"))
    return _finish(active, inactive, fit(active, k)).select(*SEGMENT_COLUMNS)


def active_users(demographics: DataFrame, as_of: dt.date | str, min_minutes: float = TRAIN_MIN_MINUTES) -> DataFrame:
    """The active users that the model-quality checks look at."""
    users = tables.stage(with_account_age(demographics, as_of))
    return split_inactive(users, inactive_condition("rate", RATE_RULE_MIN_RATE, min_minutes))[0]


# --- scoring what changed ---------------------------------------------------------------------


def score_frozen(
    demographics: DataFrame, as_of: dt.date | str, model: ExactModel, min_rate: float = RATE_RULE_MIN_RATE,
    min_minutes: float = SCORE_MIN_MINUTES,
) -> DataFrame:
    """Segment users with a saved model's scaler, centres and labels as they are. Each row's segment
    depends on that row alone (one projection, no shuffle), so scoring some users gives what
    scoring all would give them; every row stays, equal ones too."""
    users = with_account_age(demographics, as_of)
    idle = F.coalesce(inactive_condition("rate", min_rate, min_minutes), F.lit(False))
    return _labelled(users, model, F.when(idle, INACTIVE))


def _labelled(users: DataFrame, model: ExactModel, known: Column) -> DataFrame:
    """``users`` with ``user_segment``: ``known`` where it is not NULL, else the nearest cluster's label."""
    label = F.get(F.array(*[F.lit(x) for x in model.labels]), F.col("cluster"))
    return model.cluster(users).withColumn("user_segment", F.coalesce(known, label)).drop("cluster")


def rescore_changed(
    stored: DataFrame, users: DataFrame, daily: DataFrame, changed_days: Iterable[dt.date], as_of: dt.date | str, model: ExactModel,
    changed_users: DataFrame | None = None, min_rate: float = RATE_RULE_MIN_RATE, min_minutes: float = SCORE_MIN_MINUTES,
) -> DataFrame:
    """M8/Q7 over what changed since the last run with the same model: equal to
    :func:`score_frozen` of everybody, and new contents for the ``stored`` table (its result).

    ``daily`` is the per-(user, day) metrics table. Users are summed up and scored again if they
    have metrics on ``changed_days`` (new or corrected days; a partition filter), are not in
    ``stored``, or are in ``changed_users`` (user_id; those whose attributes changed, or whose corrected
    days lost all rows). The others keep metrics and segment; only their account age moves on, and with it
    the inactive rule, which is looked at again in the same projection."""
    from meeple.plans import gold

    wanted = daily.filter(F.col("event_date").isin(list(changed_days))).select("user_id")
    if changed_users is not None:
        wanted = wanted.unionByName(changed_users.select("user_id"))
    joined = users.select("user_id").join(stored.select("user_id"), "user_id", "left_anti")
    again = tables.stage(wanted.unionByName(joined).filter("user_id IS NOT NULL").distinct())
    touched = gold.user_demographics_from_daily(
        users.join(again, "user_id", "left_semi"), daily.join(again, "user_id", "left_semi")
    )
    left = users.select(F.col("user_id").alias("listed")).distinct()
    kept = stored.join(again, "user_id", "left_anti").join(left, F.col("user_id") == F.col("listed"), "left_semi")
    aged = with_account_age(kept.drop("user_age_days"), as_of)
    idle = F.coalesce(inactive_condition("rate", min_rate, min_minutes), F.lit(False))
    moved = F.when(idle, INACTIVE).when(F.col("user_segment") != INACTIVE, F.col("user_segment"))
    scored = score_frozen(touched, as_of, model, min_rate, min_minutes)
    return _labelled(aged, model, moved).select(*stored.columns).unionByName(scored.select(*stored.columns))


# --- model quality ----------------------------------------------------------------------------


def silhouettes(points: DataFrame, models: dict[int, list[Centre]]) -> dict[int, float]:
    """Mean silhouette (squared Euclidean) of each model, to 6 decimals, from the clusters'
    counts, sums and sums of squares: two aggregates for all models, no pairs. A user's value is
    taken to 9 decimals before the (exact) sum; 0 for a user alone in a cluster."""
    stats = _sums(points, models, squares=True)
    of = {k: [stats.get((k, i)) for i in range(len(models[k]))] for k in models}
    literal = lambda k, field: _numbers((None if c is None else c[field] for c in of[k]), _DEC)
    fields = {"n": 0, **{f"s{j}": 1 + j for j in range(len(_Q))}, "t": 1 + len(_Q)}
    placed = _assigned(points, models, {name: {k: literal(k, field) for k in models} for name, field in fields.items()})
    exact = [F.col(q).cast(_DEC) for q in _Q]
    length = sum((q * q for q in exact[1:]), exact[0] * exact[0])
    own, other = F.lit(None).cast("double"), []
    for i in range(max(map(len, models.values()))):
        at = lambda name: F.get(F.col(name), F.lit(i))
        inner = sum((q * at(f"s{j + 1}") for j, q in enumerate(exact[1:])), exact[0] * at("s0"))
        total = (length * at("n") + at("t") - inner * F.lit(2)).cast("double")
        mine = F.col("cluster") == i
        own = F.when(mine & (at("n") > 1), total / (at("n").cast("double") - 1)).otherwise(own)
        other.append(F.when(~mine, total / at("n").cast("double")))
    judged = placed.select("k", "w", own.alias("own"), F.array_min(F.array(*other)).alias("rest"))
    most = F.greatest("own", "rest")
    value = F.when(F.col("own").isNull() | F.col("rest").isNull() | (most == 0), 0.0).otherwise((F.col("rest") - F.col("own")) / most)
    rows = judged.groupBy("k").agg(
        F.sum(F.floor(value * 1e9 + 0.5).cast(_DEC) * F.col("w")).alias("total"), F.sum("w").alias("n")
    ).collect()
    return {r["k"]: round(int(r["total"]) / (r["n"] * 10**9), 6) for r in rows}


def silhouette(spark: SparkSession, active: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The silhouette of the fitted model, as a one-row frame."""
    return k_sweep(spark, active, [k]).select("silhouette")


def k_sweep(spark: SparkSession, active: DataFrame, ks: Iterable[int] = range(2, 9), rounds: int = ROUNDS) -> DataFrame:
    """The silhouette of each k (the data of the elbow plot). All models share every scan: one
    walk for the starting points (a smaller k starts from the first of them), one aggregate a
    round, two for the silhouettes. With fewer different users than k: of the model that there is;
    NULL without any."""
    points, _ = prepared(active)
    ks = sorted(ks)
    start = starting_points(points, ks[-1])
    scores = silhouettes(points, lloyd(points, {k: start[:k] for k in ks}, rounds)) if start else {}
    return spark.createDataFrame([(k, scores.get(k)) for k in ks], "k int, silhouette double")
