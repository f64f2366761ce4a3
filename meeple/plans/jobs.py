"""Scheduled jobs over a folder of Parquet tables (the reference's notebook sequence).

``run_days``: raw tables of a set of days -> silver sessions, purchases, leaderboard (whole
days replaced, silver sessions optionally compacted) -> the days' session and purchase cells
-> gold daily summary upserted by day, and the per-user metrics by day. Rerunning a day
leaves every table as one run would, also where its corrected raw rows give none.

``run_segmentation``: gold user demographics -> K-means segments (full overwrite) and the
fitted model saved with a production pointer; ``run_scoring`` re-segments with it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meeple.operators import tables, versions
from meeple.plans import active_users, exact_segments, gold, segments, silver
from meeple.sources import ingest
from meeple.sources.readers import as_date, days
from meeple.sources.schemas import PARTITION_COLUMNS, SCHEMAS, conform, schema_of


#: Sessions times logins of a (user, day) above which the silver join splits it.
HOT_CELL_ROWS = 1 << 22


@dataclass(frozen=True)
class Lake:
    """Table locations under one base folder (shared storage on a cluster)."""

    base: str

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))

    def read_days(self, spark: SparkSession, table: str, run_dates, schema: T.StructType) -> DataFrame:
        """Some days of a table written by this job, read with its known schema: a table
        that has received no rows yet (an empty first day) reads as empty."""
        if not self.exists(spark, table, schema):
            return spark.createDataFrame([], schema)
        return days(spark.read.schema(schema).parquet(self.path(table)), run_dates)

    def exists(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> bool:
        """Is there a folder (with files, if the schema has to come from them)? Any other trouble,
        such as a storage or permission error, is raised."""
        try:
            reader = spark.read.schema(schema) if schema is not None else spark.read
            reader.parquet(self.path(table)).schema
            return True
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise


def write_raw(df: DataFrame, lake: Lake, table: str) -> None:
    """Append typed raw rows to a raw table partitioned by day."""
    tables.append(conform(df, table), lake.path(table), PARTITION_COLUMNS[table])


def ingest_crm(spark: SparkSession, lake: Lake, exports: dict[str, DataFrame]) -> None:
    """Append CRM exports (columns suffixed ``__c``), by raw table name, to the raw tables."""
    for table, export in exports.items():
        tables.append(ingest.from_crm(export, table), lake.path(table), PARTITION_COLUMNS.get(table))


def run_days(
    spark: SparkSession,
    lake: Lake,
    run_dates,
    compact_files: int | None = None,
    one_login_per_day: bool = False,
    cell_rows: int | None = HOT_CELL_ROWS,
    database: str | None = None,
) -> DataFrame:
    """Refresh silver and gold for a set of days (a day, a backfill) in one pass; returns the gold
    rows written.

    ``one_login_per_day=True`` matches a session with its day's earliest login only, in silver
    and in gold, instead of every login as the reference does. ``compact_files`` rewrites each
    day of silver sessions in that many files by user. ``cell_rows``: see
    :func:`meeple.plans.silver.user_sessions`. ``database``: publish silver and the summary
    through its catalog tables, whole days at once (:func:`meeple.operators.versions.swap_days`);
    they are then read by table name. By default days are replaced in the tables' folders.
    """
    if database is not None:
        if compact_files:
            raise ValueError("compact_files is for tables kept by path")
        create_tables(spark, lake, database)

    def publish(df: DataFrame, table: str) -> None:
        if database is None:
            tables.replace_days(df, lake.path(table), wanted)
        else:
            versions.swap_days(spark, f"{database}.{table}", conform(df, table), wanted)

    wanted = sorted({as_date(d) for d in run_dates})
    users = lake.read(spark, "raw_users")
    sessions, logins, purchases, board = (
        days(lake.read(spark, t), wanted)
        for t in ("raw_game_sessions", "raw_logins", "raw_purchases", "raw_leaderboard_snapshots")
    )

    sil_sessions = silver.user_sessions(sessions, users, logins, None, one_login_per_day, None if one_login_per_day else cell_rows)
    if compact_files:
        with tables.staging():
            joined = tables.stage(sil_sessions)  # cut points, then the rewrite: joined once
            for d in wanted:
                one = tables.compacted(days(joined, [d]), "user_id", compact_files)
                tables.replace_days(one, lake.path("silver_user_sessions"), [d], rebalance=False)
    else:
        publish(sil_sessions, "silver_user_sessions")
    publish(silver.purchases_enriched(purchases, users), "silver_purchases_enriched")
    publish(silver.leaderboard_enriched(board, users, sessions), "silver_leaderboard_enriched")

    # The days' session and purchase cells (per user, weighted) are stored once; the summary,
    # its distinct users and the per-user metrics all read them.
    new_cells = gold.weighted_session_cells(sessions, logins, users, one_login_per_day)
    new_bought = gold.purchase_cells(purchases, users)
    tables.replace_days(new_cells, lake.path("gold_session_cells"), wanted)
    tables.replace_days(new_bought, lake.path("gold_purchase_cells"), wanted)
    cells = lake.read_days(spark, "gold_session_cells", wanted, new_cells.schema)
    bought = lake.read_days(spark, "gold_purchase_cells", wanted, new_bought.schema)
    # MERGE INTO gold ON event_date: the key is the partition column, so replacing the
    # days' partitions is the upsert (matched day updated, new day inserted).
    summary = conform(gold.daily_summary_from_cells(cells, bought), "gold_daily_summary")
    publish(summary, "gold_daily_summary")
    # The per-user metrics by day: demographics add these up instead of rescanning history.
    tables.replace_days(gold.user_day_metrics_from_cells(cells, bought), lake.path("gold_user_day_metrics"), wanted)
    if database is not None:
        return days(spark.table(f"{database}.gold_daily_summary"), wanted)
    return lake.read_days(spark, "gold_daily_summary", wanted, summary.schema)


def store_active_users(spark: SparkSession, lake: Lake, run_dates) -> None:
    """After :func:`run_days`: number the users that are new, and store the days' bitmaps of active
    users, from the days' cells. :func:`active_users_by_day` reads them over any days."""
    wanted = sorted({as_date(d) for d in run_dates})
    with tables.staging():
        cells = days(lake.read(spark, "gold_session_cells"), wanted).select("user_id", "event_date")
        schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("number", T.LongType())])
        known = spark.read.schema(schema).parquet(lake.path("user_numbers")) if lake.exists(spark, "user_numbers", schema) else None
        tables.append(active_users.number_users(cells, known), lake.path("user_numbers"))
        bitmaps = active_users.day_bitmaps(cells, lake.read(spark, "user_numbers"))
        tables.replace_days(bitmaps, lake.path("gold_user_bitmaps"), wanted)


def active_users_by_day(spark: SparkSession, lake: Lake) -> DataFrame:
    """Distinct users by day, and of the 7 and 30 days that end with it, over all stored days."""
    return active_users.rolling_users(lake.read(spark, "gold_user_bitmaps"))


def run_day(spark: SparkSession, lake: Lake, run_date: dt.date | str, **options) -> DataFrame:
    """:func:`run_days` for one day (the scheduled job)."""
    return run_days(spark, lake, [run_date], **options)


def demographics_from_lake(spark: SparkSession, lake: Lake) -> DataFrame:
    """Q5 over every day the daily job has run: users joined to the per-user sums of the
    per-(user, day) metrics table (one row per active user and day, not raw history)."""
    return gold.user_demographics_from_daily(
        lake.read(spark, "raw_users"), lake.read(spark, "gold_user_day_metrics")
    )


def run_segmentation(
    spark: SparkSession, lake: Lake, as_of: dt.date | str, model_version: str, k: int = 3, seed: int = 42,
    rule: str = "rate", exact: bool = False,
) -> str:
    """Train on today's demographics, overwrite ``gold_user_demographics`` (schema
    replaced), save the model as ``model_version`` and point production at it. ``exact``: the
    segmentation in whole numbers in place of Spark ML's."""
    with tables.staging():
        demographics = demographics_from_lake(spark, lake)
        if exact:
            segs, model = exact_segments.train_segments(demographics, as_of, k, rule=rule)
        else:
            segs, model = segments.train_segments(demographics, as_of, k, seed, rule=rule)
        tables.overwrite(segs, lake.path("gold_user_demographics"))
        return segments.save_model(model, lake.path("models/user_segmentation"), model_version)


def run_scoring(spark: SparkSession, lake: Lake, as_of: dt.date | str, refit_scaler: bool = True) -> None:
    """Re-segment with the production model, of either kind, and overwrite
    ``gold_user_demographics`` (it is not read here: demographics come from the users and their
    metrics by day)."""
    with tables.staging():
        model = segments.load_model(lake.path("models/user_segmentation"))
        kind = exact_segments if isinstance(model, exact_segments.ExactModel) else segments
        segs = kind.score_segments(demographics_from_lake(spark, lake), as_of, model, refit_scaler)
        tables.overwrite(segs, lake.path("gold_user_demographics"))


def run_frozen_scoring(spark: SparkSession, lake: Lake, as_of: dt.date | str, changed_days=None, changed_users: DataFrame | None = None) -> None:
    """Score with the production model (in whole numbers) as it is: scaler, centres and labels. Without
    ``changed_days`` everybody; with them (the days run since the last scoring with this model) only
    the users that :func:`meeple.plans.exact_segments.rescore_changed` finds, the others as stored."""
    model = segments.load_model(lake.path("models/user_segmentation"))
    if not isinstance(model, exact_segments.ExactModel):
        raise ValueError("the production model is not one in whole numbers")
    with tables.staging():
        if changed_days is None:
            segs = exact_segments.score_frozen(demographics_from_lake(spark, lake), as_of, model)
        else:
            stored = lake.read(spark, "gold_user_demographics")
            users, daily = lake.read(spark, "raw_users"), lake.read(spark, "gold_user_day_metrics")
            segs = exact_segments.rescore_changed(stored, users, daily, [as_date(d) for d in changed_days], as_of, model, changed_users)
        # what is read can't be overwritten: the new rows are stored first
        tables.overwrite(tables.stage(segs), lake.path("gold_user_demographics"))


def run_simple_segments(spark: SparkSession, lake: Lake) -> None:
    """The older segmentation of the gold table into ``gold_user_segments`` (9 columns)."""
    with tables.staging():
        segs = segments.simple_segments(lake.read(spark, "gold_user_demographics"))
        tables.overwrite_keeping_schema(segs, lake.path("gold_user_segments"), schema_of("gold_user_segments"))


def create_tables(spark: SparkSession, lake: Lake, database: str = "analytics") -> list[str]:
    """The schema with its typed tables, empty where there are no files yet (S1). Returns the
    names. Existing tables stay as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    created = []
    for table, schema in SCHEMAS.items():
        if table not in LAKE_TABLES:
            continue
        parts = PARTITION_COLUMNS.get(table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet "
            + (f"PARTITIONED BY ({', '.join(parts)}) " if parts else "")
            + f"LOCATION '{lake.path(table)}'"
        )
        created.append(f"{database}.{table}")
    return created


LAKE_TABLES = [
    "raw_users", "raw_logins", "raw_game_sessions", "raw_purchases", "raw_leaderboard_snapshots",
    "silver_user_sessions", "silver_purchases_enriched", "silver_leaderboard_enriched",
    "gold_session_cells", "gold_purchase_cells", "gold_daily_summary", "gold_user_day_metrics",
    "user_numbers", "gold_user_bitmaps",
    "gold_user_demographics", "gold_user_segments",
]


def register_tables(spark: SparkSession, lake: Lake, database: str = "analytics") -> list[str]:
    """Expose the lake's existing tables as external catalog tables of ``database``, so SQL
    such as ``SELECT * FROM analytics.silver_user_sessions LIMIT 100`` runs unchanged.
    Only metadata is written: the day folders present are registered as partitions (call
    again after new days are written). Returns the registered names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    registered = []
    for table in LAKE_TABLES:
        if not lake.exists(spark, table):
            continue
        name = f"{database}.{table}"
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=lake.path(table), source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)  # day folders written since the last call
        spark.catalog.refreshTable(name)
        registered.append(name)
    return registered
