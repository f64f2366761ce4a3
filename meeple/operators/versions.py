"""Catalog tables partitioned into folders that are swapped by location.

A partition of an external table is a folder that the catalog points to. New contents go to a
fresh folder first; when all are written, one ``ALTER TABLE ... SET LOCATION`` for each partition
publishes them. A reader plans its scan from the catalog's locations, so whenever it starts it
sees whole old or whole new partitions, and files it has begun to read are still there: old folders
go later (:func:`drop_unused_versions`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meeple.operators.tables import delete_path

Spec = tuple[tuple[str, str], ...]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _clause(spec: Spec) -> str:
    quoted = (f"`{c}` = '" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for c, v in spec)
    return f"PARTITION ({', '.join(quoted)})"


def partitions(spark: SparkSession, table: str) -> list[Spec]:
    """Column and value (as text) of each partition that the catalog knows."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [tuple((c, unquote(v)) for c, v in (part.split("=", 1) for part in r[0].split("/"))) for r in rows]


def location(spark: SparkSession, table: str, spec: Spec | None = None) -> str:
    """Folder of a table, or of one of its partitions."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_clause(spec) if spec else ''}").collect()
    found = [r["data_type"] for r in rows if r["col_name"] == "Location"]
    return found[0]  # the partition's own comes before the table's


def _folder(version: str, spec: Spec) -> str:
    return version + "".join(f"/{c}={v}" for c, v in spec)


def _point(spark: SparkSession, table: str, spec: Spec, folder: str, known: bool) -> None:
    folder = folder.replace("\\", "\\\\").replace("'", "\\'")
    if known:
        spark.sql(f"ALTER TABLE {table} {_clause(spec)} SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_clause(spec)} LOCATION '{folder}'")


def fresh_version(base: str) -> str:
    return f"{base.rstrip('/')}.versions/{uuid.uuid4().hex}"


# --- days -------------------------------------------------------------------------------------


def write_days(df: DataFrame, days: Sequence[dt.date], version: str, column: str = "event_date") -> list[dt.date]:
    """Write ``df`` into the folders of a fresh version, dealt by day; returns the days with rows.
    Rows of other days are an error: they would be written and never be published."""
    observed = Observation()
    flags = [F.count(F.when(F.col(column) == F.lit(d), 1)).alias(f"d{i}") for i, d in enumerate(days)]
    df.hint("rebalance", column).observe(observed, F.count(F.lit(1)).alias("all"), *flags).write.partitionBy(column).parquet(version)
    counts = observed.get
    if counts["all"] != sum(counts[f"d{i}"] for i in range(len(days))):
        delete_path(df.sparkSession, version)
        raise ValueError(f"rows outside the days {[d.isoformat() for d in days]}")
    return [d for i, d in enumerate(days) if counts[f"d{i}"]]


def publish_day(spark: SparkSession, table: str, day: dt.date, version: str | None, column: str = "event_date") -> None:
    """Point one day at its folder in ``version``, or at none (a day without rows)."""
    spec = ((column, day.isoformat()),)
    if version is None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_clause(spec)}")
    else:
        _point(spark, table, spec, _folder(version, spec), spec in partitions(spark, table))


def swap_days(spark: SparkSession, table: str, df: DataFrame, days: Sequence[dt.date], column: str = "event_date") -> str:
    """S9 on a catalog table partitioned by day: afterwards it holds exactly ``df``'s rows on ``days``
    (one without rows is empty) and other days as before. All days are written before the first is
    published, each at once; a failed write changes nothing. Returns the new version's folder."""
    version = fresh_version(location(spark, table))
    with_rows = set(write_days(df, days, version, column))
    for day in days:
        publish_day(spark, table, day, version if day in with_rows else None, column)
    spark.catalog.refreshTable(table)
    return version


def drop_unused_versions(spark: SparkSession, table: str) -> int:
    """Delete the partition folders of old versions that no partition of the table points to any
    more; returns how many. Run it when no reader of an older state is left."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{location(spark, table).rstrip('/')}.versions")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return 0
    used = {_plain(location(spark, table, spec)) for spec in partitions(spark, table)}
    depth = len(partition_columns(spark, table))
    folders = [s.getPath() for s in fs.listStatus(base) if s.isDirectory()]
    dropped = 0
    for folder in folders:
        level = [folder]
        for _ in range(depth):
            level = [s.getPath() for f in level for s in fs.listStatus(f) if s.isDirectory()]
        unused = [f for f in level if _plain(f.toString()) not in used]
        for f in unused:
            fs.delete(f, True)
        dropped += len(unused)
        if len(unused) == len(level):
            fs.delete(folder, True)
    return dropped


def _plain(path: str) -> str:
    """A location without its scheme and empty authority, to compare."""
    scheme, _, rest = path.partition(":")
    return "/" + rest.lstrip("/") if rest and "/" not in scheme else path


# --- columns ----------------------------------------------------------------------------------


def alter_columns(spark: SparkSession, table: str, add: dict[str, str] | None = None, drop: Sequence[str] = ()) -> None:
    """S13, S14 on a catalog table, partitioned or not: add columns (NULL on existing rows) and drop
    columns, in the catalog only. The table gets a new version of its schema over the same folders;
    Parquet columns are found by name, so files with and without a column are read together. A
    dropped column's values stay in old files until :func:`rewrite`, so a name that files still
    hold can't be added again before."""
    add, parts = dict(add or {}), partition_columns(spark, table)
    fields = spark.table(table).schema.fields
    names = [f.name for f in fields]
    if unknown := [c for c in drop if c not in names]:
        raise ValueError(f"{table} has no columns {unknown}")
    if bound := [c for c in drop if c in parts]:
        raise ValueError(f"{table} is partitioned by {bound}")
    if taken := [c for c in add if c in names]:
        raise ValueError(f"{table} already has {taken}")
    held = set(_file_columns(spark, table)) - set(names) if add else set()
    if left_over := [c for c in add if c in held]:
        raise ValueError(f"files of {table} still hold dropped columns {left_over}: rewrite it first")
    if not drop:
        if add:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in add.items())})")
        return
    kept = [f for f in fields if f.name not in drop and f.name not in parts]
    columns = [(f.name, f.dataType.simpleString()) for f in kept] + list(add.items())
    columns += [(f.name, f.dataType.simpleString()) for f in fields if f.name in parts]
    _recreate(spark, table, columns, parts)


def _file_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns of the table's files, whatever the catalog lists."""
    files = [unquote(f) for f in spark.table(table).inputFiles()]
    return spark.read.option("mergeSchema", True).parquet(*files).columns if files else []


def _recreate(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]], parts: Sequence[str]) -> None:
    """The external table again, with other columns, over its present folders (files are not touched)."""
    base = location(spark, table)
    folders = [(spec, location(spark, table, spec)) for spec in partitions(spark, table)] if parts else []
    spark.sql(f"DROP TABLE {table}")
    listed = ", ".join(f"`{c}` {t}" for c, t in columns)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)}) " if parts else ""
    spark.sql(f"CREATE TABLE {table} ({listed}) USING parquet {by}LOCATION '{base}'")
    for spec, folder in folders:
        _point(spark, table, spec, folder, False)
    spark.catalog.refreshTable(table)


def rewrite(spark: SparkSession, table: str, rows: DataFrame | None = None) -> None:
    """New contents for a catalog table partitioned by folders: ``rows`` (by default its own, which
    drops what files hold of dropped columns), with any columns as long as the partition columns
    are among them. Written to a fresh version, then published partition by partition; a partition
    without rows goes. With other columns than before the table is first given the new schema, which the
    old files can be read under, too."""
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} is not partitioned")
    rows = spark.table(table) if rows is None else rows
    if missing := [c for c in parts if c not in rows.columns]:
        raise ValueError(f"{table} is partitioned by {missing}")
    ordered = [c for c in rows.columns if c not in parts] + parts
    version = fresh_version(location(spark, table))
    rows.select(*ordered).hint("rebalance", *parts).write.partitionBy(*parts).parquet(version)
    before = {f.name: f.dataType for f in spark.table(table).schema.fields}
    after = rows.select(*ordered).schema
    if before != {f.name: f.dataType for f in after.fields}:
        _recreate(spark, table, [(f.name, f.dataType.simpleString()) for f in after.fields], parts)
    known = set(partitions(spark, table))
    written = _written(spark, version, parts)
    for spec, folder in written:
        _point(spark, table, spec, folder, spec in known)
    for spec in known - {spec for spec, _ in written}:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_clause(spec)}")
    spark.catalog.refreshTable(table)


def _written(spark: SparkSession, version: str, parts: Sequence[str]) -> list[tuple[Spec, str]]:
    """Specs and paths of the folders in a version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(version)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    level: list[tuple[Spec, object]] = [((), path)]
    for _ in parts:
        level = [
            ((*spec, tuple(unquote(x) for x in s.getPath().getName().split("=", 1))), s.getPath())
            for spec, p in level for s in fs.listStatus(p) if s.isDirectory()
        ]
    return [(spec, p.toString()) for spec, p in level]
