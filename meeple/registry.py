"""Named queries over a test-data folder: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through :mod:`meeple.sources.adapters` and runs the
library's own job on all of their rows. ``meeple.oracle.ORACLE`` holds the DuckDB SQL
for the same names, where SQL can express the job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.operators import sampling, tables
from meeple.plans import active_users, exact_segments, gold, gold_feed, questions, segments, silver
from meeple.session import unique_path
from meeple.sources import ingest
from meeple.sources.adapters import AS_OF, RUN_DATE, RawTables, load_raw
from meeple.sources.readers import day

Query = Callable[[SparkSession, str], DataFrame]


def _silver_sessions(spark: SparkSession, sf: str, run_date=None, one_login=False, cell_rows=None) -> DataFrame:
    r = load_raw(spark, sf)
    return silver.user_sessions(r.sessions, r.users, r.logins, run_date, one_login, cell_rows)


def _silver_purchases(spark: SparkSession, sf: str, run_date=None) -> DataFrame:
    r = load_raw(spark, sf)
    return silver.purchases_enriched(r.purchases, r.users, run_date)


def _silver_leaderboard(spark: SparkSession, sf: str, run_date=None) -> DataFrame:
    r = load_raw(spark, sf)
    return silver.leaderboard_enriched(r.leaderboard, r.users, r.sessions, run_date)


def _daily_summary(spark: SparkSession, sf: str, run_date=None, one_login=False) -> DataFrame:
    r = load_raw(spark, sf)
    summary = gold.daily_summary(r.sessions, r.logins, r.purchases, r.users, run_date, one_login)
    return summary.orderBy("event_date")


def _demographics(spark: SparkSession, sf: str) -> DataFrame:
    r = load_raw(spark, sf)
    return gold.user_demographics(r.users, r.sessions, r.logins, r.purchases)


def _aged(spark: SparkSession, sf: str) -> DataFrame:
    return segments.with_account_age(_demographics(spark, sf), AS_OF)


def _split(spark: SparkSession, sf: str, rule="rate", **params):
    return segments.split_inactive(_aged(spark, sf), segments.inactive_condition(rule, **params))


def _synthetic_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Active users (rate rule, 15 min) with a stand-in cluster id (user id mod 3), to
    check the profiling and labelling steps without K-means."""
    active, _ = _split(spark, sf)
    return active.withColumn("cluster", F.pmod(F.col("user_id").cast("long"), F.lit(3)).cast("int"))


def _synthetic_segments(spark: SparkSession, sf: str) -> DataFrame:
    _, inactive = _split(spark, sf)
    labelled = segments.label_clusters(_synthetic_clusters(spark, sf)).drop("cluster")
    return labelled.unionByName(segments.tag(inactive, segments.INACTIVE))


def _trained(spark: SparkSession, sf: str):
    return exact_segments.train_segments(_demographics(spark, sf), AS_OF)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Train, save with a production pointer, load it back and score (the demographics
    both steps read are computed once)."""
    demographics = tables.stage(_demographics(spark, sf))
    _, model = exact_segments.train_segments(demographics, AS_OF)
    base = unique_path(spark, "models", "user_segmentation")
    segments.save_model(model, base, "v1")
    return exact_segments.score_segments(demographics, AS_OF, segments.load_model(base), refit_scaler=True)


# A model in whole numbers whose result SQL can compute: scaler, centres and labels are given.
GIVEN_MODEL = exact_segments.ExactModel(
    exact_segments.Scaler(1000, (8000, 1_500_000, 2_000_000, 1500), (89_000, 2_500_000_000, 8_000_000_000, 6250)),
    [(-500, -500, -500, -500), (500, 1000, -250, -250), (250, 0, 1500, 1500)], ("Casual", "Hardcore", "Whale"),
)
LAST_RUN, LAST_DAY = dt.date(2024, 1, 22), dt.date(2024, 1, 20)


def _rescored(spark: SparkSession, sf: str) -> DataFrame:
    """Segments stored by an earlier run (fewer days, fewer users), brought up to the present."""
    r = load_raw(spark, sf)
    daily = tables.stage(gold.user_day_metrics(r.sessions, r.logins, r.purchases, r.users))
    earlier = r.users.filter(F.col("user_id").cast("long") % 47 != 0)
    before = gold.user_demographics_from_daily(earlier, daily.filter(F.col("event_date") <= F.lit(LAST_DAY)))
    stored = tables.stage(exact_segments.score_frozen(before, LAST_RUN, GIVEN_MODEL))
    last = daily.agg(F.max("event_date")).first()[0] or LAST_DAY
    new_days = [LAST_DAY + dt.timedelta(i) for i in range(1, (last - LAST_DAY).days + 1)]
    return exact_segments.rescore_changed(stored, r.users, daily, new_days, AS_OF, GIVEN_MODEL)


def _trained_ml(spark: SparkSession, sf: str):
    return segments.train_segments(_demographics(spark, sf), AS_OF)


def _scored_ml(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`_scored` with the Spark ML trainer."""
    demographics = tables.stage(_demographics(spark, sf))
    _, model = segments.train_segments(demographics, AS_OF)
    base = unique_path(spark, "models", "user_segmentation")
    segments.save_model(model, base, "v1")
    return segments.score_segments(demographics, AS_OF, segments.load_model(base), refit_scaler=True)


# Points in the scaled feature space, as centroids of a model whose result SQL can compute.
GIVEN_CENTROIDS = [(-0.5, -0.5, -0.5, -0.5), (0.5, 1.0, -0.25, -0.25), (0.25, 0.0, 1.5, 1.5)]


def _given_model(spark: SparkSession) -> PipelineModel:
    """The three-stage pipeline with K-means fitted to the given points (k of them, so each is its
    own centroid), its scaler fitted to rows that scoring never sees."""
    points = spark.createDataFrame([(Vectors.dense(p),) for p in GIVEN_CENTROIDS], ["scaled_features"])
    centroids = segments.kmeans(k=len(GIVEN_CENTROIDS)).fit(points.coalesce(1))
    rows = spark.createDataFrame([(1, 1.0, 1.0, 1), (2, 3.0, 5.0, 4)], "total_sessions long, avg_session_duration double, total_spent double, num_purchases long")
    scaled = Pipeline(stages=[segments.assembler(), segments.scaler()]).fit(rows)
    return PipelineModel([*scaled.stages, centroids])


def _scored_given_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """The scoring job with known centroids: the scaler is fitted again on the active users."""
    return segments.score_segments(_demographics(spark, sf), AS_OF, _given_model(spark), refit_scaler=True)


def _silhouette_given_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouette of the active users under the stand-in clusters (6 decimals)."""
    scaled = segments.active_features(_demographics(spark, sf), AS_OF, segments.TRAIN_MIN_MINUTES)
    clustered = scaled.withColumn("cluster", F.pmod(F.col("user_id").cast("long"), F.lit(3)).cast("int"))
    return segments.silhouette(spark, clustered).select(F.round("silhouette", 6).alias("silhouette"))


def _simple(spark: SparkSession, sf: str) -> DataFrame:
    trained, _ = _trained(spark, sf)
    return exact_segments.simple_segments(trained)


def _exact_active(spark: SparkSession, sf: str) -> DataFrame:
    return exact_segments.active_users(_demographics(spark, sf), AS_OF)


def _simple_ml(spark: SparkSession, sf: str) -> DataFrame:
    trained, _ = _trained_ml(spark, sf)
    return segments.simple_segments(trained)


def _silhouette_ml(spark: SparkSession, sf: str) -> DataFrame:
    scaled = segments.active_features(_demographics(spark, sf), AS_OF, segments.TRAIN_MIN_MINUTES)
    clustered = segments.kmeans().fit(scaled).transform(scaled)
    return segments.silhouette(spark, clustered)


def _k_sweep_ml(spark: SparkSession, sf: str) -> DataFrame:
    scaled = segments.active_features(_demographics(spark, sf), AS_OF, segments.TRAIN_MIN_MINUTES)
    return segments.k_sweep(spark, scaled)


_RAW_CONTRACTS = {
    "users": "raw_users",
    "logins": "raw_logins",
    "sessions": "raw_game_sessions",
    "purchases": "raw_purchases",
    "leaderboard": "raw_leaderboard_snapshots",
}


def _raw(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return getattr(load_raw(spark, sf), kind)


def _typed(kind: str) -> Query:
    """Rows arriving as text (as a CSV export or an untyped source gives them) cast to
    the table contract."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = _raw(spark, sf, kind)
        as_text = raw.select(*[F.col(c).cast("string") for c in raw.columns])
        return ingest.typed(as_text, _RAW_CONTRACTS[kind])

    return run


def _crm(kind: str) -> Query:
    """A CRM export (columns suffixed __c) mapped back onto the raw table by name."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        exported = ingest.crm_export(_raw(spark, sf, kind))
        return ingest.from_crm(exported, _RAW_CONTRACTS[kind])

    return run


# Cells that are broken on purpose: (column, text put there, where).
_BROKEN: dict[str, list[tuple[str, str | None, str]]] = {
    "users": [("signup_date", "soon", "user_id % 17 = 0"), ("age", "12.5x", "user_id % 13 = 0"), ("user_id", None, "user_id % 19 = 0")],
    "logins": [("timestamp", "2024-99-01 00:00:00", "location = 'City_3'"), ("event_date", "n/a", "location = 'City_5'"), ("user_id", " ", "location = 'City_8'")],
    "sessions": [("start_time", "yesterday", "session_id % 23 = 0"), ("score", "ten", "session_id % 29 = 0"), ("end_time", "25:61", "session_id % 31 = 0"),
                 ("session_id", None, "session_id % 37 = 0")],
    "purchases": [("amount", "1,5", "purchase_id % 7 = 0"), ("timestamp", "never", "purchase_id % 11 = 0"), ("event_date", "2024-02-30", "purchase_id % 5 = 0")],
    "leaderboard": [("rank", "first", "rank = 1"), ("event_date", "", "rank = 2")],
}


def _checked(kind: str, pick: Callable[[DataFrame], DataFrame]) -> Query:
    """S7 with rejects: the raw rows as text, some cells broken, cast with a reject path."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = _raw(spark, sf, kind)
        broken = {c: F.col(c).cast("string") for c in raw.columns}
        for column, text, where in _BROKEN[kind]:
            broken[column] = F.when(F.expr(where), F.lit(text)).otherwise(broken[column])
        return pick(ingest.checked(raw.select(*[x.alias(c) for c, x in broken.items()]), _RAW_CONTRACTS[kind]))

    return run


def _summary_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the gold daily table: the one-login summary without its last third of days
    (old) and the full summary without its first third (new), so that there are updated, deleted
    and inserted days whatever dates the data have."""
    r: RawTables = load_raw(spark, sf)
    old = gold.daily_summary(r.sessions, r.logins, r.purchases, r.users, one_login_per_day=True)
    new = gold.daily_summary(r.sessions, r.logins, r.purchases, r.users)
    span = r.sessions.agg(F.min("event_date").alias("first"), F.datediff(F.max("event_date"), F.min("event_date")).alias("days")).first()
    third = span["days"] // 3
    first_third = span["first"] + dt.timedelta(days=third)
    last_third = span["first"] + dt.timedelta(days=span["days"] - third)
    return old.filter(F.col("event_date") <= F.lit(last_third)), new.filter(F.col("event_date") >= F.lit(first_third))


def _earlier_raw(r: RawTables) -> dict[str, DataFrame]:
    """An earlier version of the raw tables: rows not there yet, rows with other values, rows that
    are gone since (on days of their own, too), users listed more or less often."""
    eid = lambda c: F.col(c).cast("long")
    s, p = r.sessions, r.purchases
    held = s.filter(eid("session_id") % 11 != 0)
    other = eid("session_id") % 13 == 0
    held = held.withColumns({
        "end_time": F.when(other, F.col("end_time") + F.expr("INTERVAL 7 MINUTES")).otherwise(F.col("end_time")),
        "user_id": F.when(other, F.lit("1")).otherwise(F.col("user_id")),
    })
    gone = s.filter(eid("session_id") % 17 == 0).withColumns({
        "session_id": F.concat(F.lit("x"), "session_id"), "event_date": F.date_add("event_date", F.when(eid("session_id") % 2 == 0, 400).otherwise(0)),
    })
    return {
        "sessions": held.unionByName(gone),
        "logins": r.logins.filter(F.col("location") != "City_7").unionByName(r.logins.filter("location = 'City_9'")),
        "purchases": p.filter(eid("purchase_id") % 10 != 0).withColumn("amount", F.when(eid("purchase_id") % 3 == 0, -F.col("amount")).otherwise(F.col("amount"))),
        "users": r.users.filter(F.col("username").endswith("_2") == F.lit(False)).unionByName(r.users.filter(F.col("user_id").cast("long") % 59 == 0)),
    }


def _advanced(spark: SparkSession, sf: str):
    """Stored gold and state of the earlier raw tables, brought up to the present ones by their
    change feeds: (old gold, new state, touched days). Past the feeds, no raw table is read."""
    r = load_raw(spark, sf)
    old = _earlier_raw(r)
    state = gold_feed.state_of(old["sessions"], old["logins"], old["purchases"], old["users"]).map(tables.stage)
    feeds = {
        "sessions": tables.signed(tables.changes(old["sessions"], r.sessions, ["session_id"])),
        "logins": tables.bag_changes(old["logins"], r.logins),
        "purchases": tables.signed(tables.changes(old["purchases"], r.purchases, ["purchase_id"])),
        "users": tables.bag_changes(old["users"], r.users),
    }
    before = tables.stage(gold_feed.summary(state))
    return before, *gold_feed.advance(state, **{k: tables.stage(f) for k, f in feeds.items()})


def _rolling_users(spark: SparkSession, sf: str) -> DataFrame:
    """Users numbered in two runs (as new ones sign up), a stored bitmap table, and the windows."""
    sessions = _raw(spark, sf, "sessions")
    first = tables.stage(active_users.number_users(sessions.filter(F.col("user_id").cast("long") % 3 != 0)))
    numbers = first.unionByName(tables.stage(active_users.number_users(sessions, first)))
    return active_users.rolling_users(tables.stage(active_users.day_bitmaps(sessions, numbers)))


def _summary_from_feed(spark: SparkSession, sf: str) -> DataFrame:
    before, state, days = _advanced(spark, sf)
    return gold_feed.advance_summary(before, state, days)


QUERIES: dict[str, Query] = {
    # Q1-Q3 silver
    "silver_user_sessions": lambda s, sf: _silver_sessions(s, sf),
    "silver_user_sessions_day": lambda s, sf: _silver_sessions(s, sf, RUN_DATE),
    "silver_user_sessions_one_login": lambda s, sf: _silver_sessions(s, sf, one_login=True),
    "silver_user_sessions_split": lambda s, sf: _silver_sessions(s, sf, cell_rows=4),
    "silver_purchases_enriched": lambda s, sf: _silver_purchases(s, sf),
    "silver_purchases_day": lambda s, sf: _silver_purchases(s, sf, RUN_DATE),
    "silver_leaderboard_enriched": lambda s, sf: _silver_leaderboard(s, sf),
    "silver_leaderboard_day": lambda s, sf: _silver_leaderboard(s, sf, RUN_DATE),
    # Q4 gold daily summary
    "daily_summary_backfill": lambda s, sf: _daily_summary(s, sf),
    "daily_summary_one_day": lambda s, sf: _daily_summary(s, sf, RUN_DATE),
    "daily_summary_from_silver": lambda s, sf: gold.daily_summary_from_silver(
        _silver_sessions(s, sf), _silver_purchases(s, sf)
    ),
    "daily_summary_from_cells": lambda s, sf: gold.daily_summary_from_cells(
        gold.weighted_session_cells(_raw(s, sf, "sessions"), _raw(s, sf, "logins"), _raw(s, sf, "users")),
        gold.purchase_cells(_raw(s, sf, "purchases"), _raw(s, sf, "users")),
    ),
    "daily_summary_one_login": lambda s, sf: _daily_summary(s, sf, one_login=True),
    "daily_summary_from_feed": _summary_from_feed,
    "rolling_active_users": _rolling_users,
    "daily_revenue": lambda s, sf: gold.daily_revenue(_silver_purchases(s, sf)),
    "peak_hour_per_day": lambda s, sf: gold.top_per_day(
        _silver_sessions(s, sf), F.hour("start_time"), "peak_hour"
    ),
    "top_device_per_day": lambda s, sf: gold.top_per_day(
        _silver_sessions(s, sf), F.col("login_device"), "top_device_type"
    ),
    # Q5 demographics
    "user_session_metrics": lambda s, sf: gold.session_metrics(
        _raw(s, sf, "sessions"), _raw(s, sf, "logins"), _raw(s, sf, "users")
    ),
    "user_purchase_metrics": lambda s, sf: gold.purchase_metrics(_silver_purchases(s, sf)),
    "user_demographics": _demographics,
    "user_demographics_from_daily": lambda s, sf: gold.user_demographics_from_daily(
        _raw(s, sf, "users"),
        gold.user_day_metrics(
            _raw(s, sf, "sessions"), _raw(s, sf, "logins"), _raw(s, sf, "purchases"), _raw(s, sf, "users")
        ),
    ),
    "user_demographics_from_feed": lambda s, sf: gold_feed.demographics(_raw(s, sf, "users"), _advanced(s, sf)[1]),
    "user_demographics_from_silver": lambda s, sf: gold.user_demographics_from_silver(
        _raw(s, sf, "users"), _silver_sessions(s, sf), _silver_purchases(s, sf)
    ),
    # M1 inactive rules, U1 EXCEPT, U2 UNION
    "inactive_rate_15": lambda s, sf: _split(s, sf)[1],
    "inactive_rate_5": lambda s, sf: _split(s, sf, min_minutes=segments.SCORE_MIN_MINUTES)[1],
    "inactive_simple": lambda s, sf: _split(s, sf, "simple")[1],
    "inactive_draft": lambda s, sf: _split(s, sf, "draft")[1],
    "active_users": lambda s, sf: _split(s, sf)[0],
    "active_inactive_union": lambda s, sf: segments.tag(_split(s, sf)[0], "Active").unionByName(
        segments.tag(_split(s, sf)[1], segments.INACTIVE)
    ),
    # M3, M5, M6, A8-A10, Q9 (labelling checked on stand-in clusters)
    "feature_zscores": lambda s, sf: segments.feature_zscores(_split(s, sf)[0]),
    "cluster_profile": lambda s, sf: segments.cluster_profile(_synthetic_clusters(s, sf)),
    "cluster_labels": lambda s, sf: segments.cluster_label_map(
        segments.cluster_profile(_synthetic_clusters(s, sf))
    ),
    "segment_profile": lambda s, sf: segments.segment_profile(_synthetic_segments(s, sf)),
    "segment_sizes": lambda s, sf: segments.segment_sizes(_synthetic_segments(s, sf)),
    "user_categories": lambda s, sf: questions.user_categories(_aged(s, sf)),
    "whales_by_country_given_clusters": lambda s, sf: segments.whales_by_country(_synthetic_segments(s, sf)),
    # K-means of whole numbers, then the Spark ML trainer (rows-only checks)
    "kmeans_segments": lambda s, sf: _trained(s, sf)[0],
    "scored_segments": _scored,
    "scored_given_centroids": _scored_given_centroids,
    "rescored_changed_users": _rescored,
    "scored_frozen": lambda s, sf: exact_segments.score_frozen(_demographics(s, sf), AS_OF, GIVEN_MODEL),
    "silhouette_given_clusters": _silhouette_given_clusters,
    "simple_segments": _simple,
    "silhouette": lambda s, sf: exact_segments.silhouette(s, _exact_active(s, sf)),
    "k_sweep": lambda s, sf: exact_segments.k_sweep(s, _exact_active(s, sf)),
    "whales_by_country": lambda s, sf: segments.whales_by_country(_trained(s, sf)[0]),
    "simple_segment_sizes": lambda s, sf: segments.segment_sizes(_simple(s, sf)),
    "simple_segment_profile": lambda s, sf: segments.segment_profile(_simple(s, sf)),
    "kmeans_segments_ml": lambda s, sf: _trained_ml(s, sf)[0],
    "scored_segments_ml": _scored_ml,
    "simple_segments_ml": _simple_ml,
    "silhouette_ml": _silhouette_ml,
    "k_sweep_ml": _k_sweep_ml,
    # Q10, Q12-Q14 questions
    "hourly_activity": lambda s, sf: questions.hourly_activity(load_raw(s, sf).sessions),
    "device_usage": lambda s, sf: questions.device_usage(load_raw(s, sf).logins),
    "user_base_makeup": lambda s, sf: questions.user_base_makeup(_demographics(s, sf)),
    "user_base_by_country": lambda s, sf: questions.user_base_by_country(_demographics(s, sf)),
    "users_by_country": lambda s, sf: questions.users_by_country(_demographics(s, sf)),
    "earnings_by_item": lambda s, sf: questions.earnings_by_item(_silver_purchases(s, sf)),
    "earnings_by_day": lambda s, sf: questions.earnings_by_day(_silver_purchases(s, sf)),
    "total_earnings": lambda s, sf: questions.total_earnings(_silver_purchases(s, sf)),
    # S2-S4, P12, A11 scans
    "scan_users": lambda s, sf: _raw(s, sf, "users"),
    "scan_user_ids": lambda s, sf: _raw(s, sf, "users").select("user_id"),
    "scan_day_sessions": lambda s, sf: day(_raw(s, sf, "sessions"), RUN_DATE),
    "preview_users": lambda s, sf: _raw(s, sf, "users").orderBy("user_id").limit(20),
    "scan_logins": lambda s, sf: _raw(s, sf, "logins"),
    "scan_sessions": lambda s, sf: _raw(s, sf, "sessions"),
    "scan_purchases": lambda s, sf: _raw(s, sf, "purchases"),
    "scan_leaderboard": lambda s, sf: _raw(s, sf, "leaderboard"),
    "preview_silver_sessions": lambda s, sf: _silver_sessions(s, sf)
    .orderBy("session_id", "login_device", "login_location")
    .limit(100),
    "row_count_users": lambda s, sf: _raw(s, sf, "users").agg(F.count(F.lit(1)).alias("row_count")),
    # S7 typed ingest, S8 CRM ingest
    **{f"bronze_{k}_typed": _typed(k) for k in _RAW_CONTRACTS},
    **{f"crm_{k}_ingest": _crm(k) for k in _RAW_CONTRACTS},
    **{f"bronze_{k}_rejects": _checked(k, ingest.rejected) for k in _RAW_CONTRACTS},
    **{f"bronze_{k}_accepted": _checked(k, ingest.accepted) for k in _RAW_CONTRACTS},
    # S12, S15-S17 table maintenance
    "upsert_daily": lambda s, sf: tables.upsert(*_summary_versions(s, sf), ["event_date"]),
    "daily_changes": lambda s, sf: tables.changes(*_summary_versions(s, sf), ["event_date"]),
    "clustered_users": lambda s, sf: tables.clustered(_raw(s, sf, "users"), "signup_date"),
    "compacted_sessions": lambda s, sf: tables.compacted(tables.stage(_silver_sessions(s, sf)), "user_id", num_files=8),
    # G1, G3, W5 samples of given rows
    "sampled_users": lambda s, sf: sampling.bernoulli(_raw(s, sf, "users"), ["user_id"], sampling.LOGIN_RATE, "logins"),
    "ranked_players": lambda s, sf: sampling.ranked_sample(
        _raw(s, sf, "sessions").filter("user_id IS NOT NULL").select("user_id", "game_type", "event_date").distinct(),
        ["game_type", "event_date"], ["user_id"], sampling.LEADERBOARD_SIZE, "players",
    ),
}
