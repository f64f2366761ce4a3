"""Incremental refresh of silver and gold as raw files arrive (Structured Streaming).

The reference reran its daily notebooks for a ``run_date``. Here file-source streams
watch the raw fact table folders (sessions, logins, purchases, leaderboard), unioned into
one query with one checkpoint; each micro-batch finds the days its new files touch, in
any of the tables, and reruns :func:`meeple.plans.jobs.run_days` for those days, all of them
in one pass. ``run_days`` replaces whole day partitions, so replaying a micro-batch after a failure
(the checkpoint decides what is replayed) rewrites the same rows: the sink is idempotent
and the result exactly-once.

Only the list of touched days reaches the driver (a handful of dates per batch), never
the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meeple.plans.jobs import Lake, run_days


def touched_days(batch: DataFrame, column: str = "event_date") -> list:
    """Distinct days present in a micro-batch (bounded by the days a batch spans)."""
    return sorted(r[0] for r in batch.select(column).distinct().collect() if r[0] is not None)


RAW_FACT_TABLES = ("raw_game_sessions", "raw_logins", "raw_purchases", "raw_leaderboard_snapshots")


def start_daily_refresh(
    spark: SparkSession,
    lake: Lake,
    checkpoint_location: str,
    source_tables: tuple[str, ...] = RAW_FACT_TABLES,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    compact_files: int | None = None,
) -> StreamingQuery:
    """Start the refresh stream over the folders of ``source_tables``.

    ``available_now=True`` processes everything present and stops (a scheduled run);
    ``False`` keeps polling for new files every minute. All new files make one batch, so a
    day is rewritten once however many files it received; ``max_files_per_trigger`` (per
    table) splits a backlog, at the price of rewriting days that span several batches.
    """
    def stream(table: str) -> DataFrame:
        reader = spark.readStream.schema(lake.read(spark, table).schema)
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(lake.path(table)).select("event_date")

    streams = [stream(table) for table in source_tables]
    days = streams[0]
    for other in streams[1:]:
        days = days.unionByName(other)

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        touched = touched_days(batch)
        if touched:
            run_days(spark, lake, touched, compact_files=compact_files)

    writer = (
        days.writeStream.queryName("refresh_daily_tables")
        .foreachBatch(refresh)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
