"""Table scans, one-day scans and CSV import/export."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple.sources.schemas import conform, schema_of


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """Scan a table: a catalog name, or a Parquet path (anything containing '/')."""
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def as_date(value: dt.date | str) -> dt.date:
    """A run date given as ``date`` or ISO ``YYYY-MM-DD`` text."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def day(df: DataFrame, run_date: dt.date | str, column: str = "event_date") -> DataFrame:
    """Rows of one day. On a table partitioned by ``column`` this prunes partitions."""
    return df.filter(F.col(column) == F.lit(as_date(run_date)))


def days(df: DataFrame, run_dates, column: str = "event_date") -> DataFrame:
    """Rows of a set of days (a small list of dates)."""
    return df.filter(F.col(column).isin([as_date(d) for d in run_dates]))


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read an exported raw table (header line, no schema inference) and cast to its contract.

    Every column is read as text first, so timestamps with or without fractions, and
    dates, parse the same way as the typed ingest does.
    """
    contract = schema_of(table)
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in contract.fields])
    raw = spark.read.schema(text).option("header", True).option("mode", "FAILFAST").csv(path)
    return conform(raw, table)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a table as header-prefixed CSV files, one per partition (no driver round trip)."""
    df.write.mode(mode).option("header", True).csv(path)
