"""Table maintenance as plain Spark jobs on Parquet tables.

* writes: append, replace whole days (dynamic partition overwrite), full overwrite
* ``upsert`` / ``upsert_table``: MERGE by key (update matched rows, insert the others),
  as a DataFrame or as a new table version swapped in through the catalog
* ``changes`` / ``apply_changes``: the change feed between two versions of a table
* ``compacted``: rewrite a day's rows in a few files by ranges of a column
* ``clustered``: rows of equal key next to each other (CLUSTER BY)
* ``add_columns`` / ``drop_columns``: schema evolution on read and on rewrite
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Casts that lose nothing.
_WIDENINGS = {
    (T.IntegerType, T.LongType), (T.IntegerType, T.DoubleType), (T.FloatType, T.DoubleType),
    (T.ShortType, T.IntegerType), (T.ShortType, T.LongType), (T.TimestampType, T.TimestampNTZType),
}

CHANGE_TYPE = "_change_type"
INSERT, DELETE = "insert", "delete"
UPDATE_PRE, UPDATE_POST = "update_preimage", "update_postimage"

# ------------------------------------------------------------------------------ writes


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append"
) -> None:
    """A Parquet table laid out in one folder per partition value."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """S9 (parity mode): INSERT INTO. Running the same day twice doubles its rows."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("event_date",)) -> None:
    """S9 (default) and S12 for partition keys: replace exactly the partitions present in
    ``df`` and keep all others (dynamic partition overwrite).

    A rerun of a day leaves the table as one run would, and an upsert keyed by the
    partition column never reads the target table at all.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_days(
    df: DataFrame, path: str, days: Sequence[dt.date], column: str = "event_date", rebalance: bool = True
) -> None:
    """S9 for a known set of days: afterwards the table holds exactly ``df``'s rows on those
    days, and a day for which ``df`` has none is empty (its folder goes). Other days stay.

    Rows are first dealt by day (``rebalance``), so a day is written by few tasks whatever the
    partitioning behind ``df``; adaptive execution splits a large day. Which days got rows is
    counted while they are written."""
    observed = Observation()
    flags = [F.count(F.when(F.col(column) == F.lit(d), 1)).alias(f"d{i}") for i, d in enumerate(days)]
    if not flags:
        return
    dealt = df.hint("rebalance", column) if rebalance else df
    replace_partitions(dealt.observe(observed, *flags), path, [column])
    counts = observed.get
    spark = df.sparkSession
    for i, d in enumerate(days):
        if not counts[f"d{i}"]:
            delete_path(spark, f"{path.rstrip('/')}/{column}={d.isoformat()}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on the storage it is on; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace the table, schema included."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_keeping_schema(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace the rows, but only with rows of the table's existing schema: the same columns,
    and types that widen to it without loss (an INT into a BIGINT, not the other way round)."""
    names = [f.name for f in schema.fields]
    if sorted(df.columns) != sorted(names):
        raise ValueError(f"columns {df.columns} do not match the table schema {names}")
    for field in schema.fields:
        have = df.schema[field.name].dataType
        if have != field.dataType and (type(have), type(field.dataType)) not in _WIDENINGS:
            raise ValueError(f"{field.name}: {have.simpleString()} does not fit {field.dataType.simpleString()}")
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode(
        "overwrite"
    ).parquet(path)


_STAGED: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def staging():
    """Within this block, everything :func:`stage` writes is deleted at the end: use it around a
    job that has written its results by then."""
    _STAGED.append([])
    try:
        yield
    finally:
        for spark, path in _STAGED.pop():
            delete_path(spark, path)


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several passes read: write it as Parquet to a fresh
    folder under the session's shared ``spark.checkpoint.dir`` and read it back. The folder is
    deleted at the end of the :func:`staging` block around the call, if there is one.

    The rows are computed once and survive executor loss. Columnar files are smaller
    than serialised checkpoint rows, and reading them back gives the planner real sizes.
    """
    from meeple.session import unique_path

    path = unique_path(df.sparkSession, "meeple-stages")
    if _STAGED:
        _STAGED[-1].append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# ------------------------------------------------------------------------------ upsert


def _unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` unchanged, failing the job if two rows share a key (MERGE would be
    ambiguous). The window shuffles by the keys, which the join then reuses."""
    counted = source.withColumn("_key_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    unique = F.when(
        F.col("_key_rows") > 1, F.raise_error(F.lit("several rows share a key"))
    ).otherwise(F.lit(True))
    return counted.filter(unique).drop("_key_rows")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE INTO target USING source ON keys: matched rows take the source values,
    unmatched source rows are inserted, other target rows stay. By column name.

    Returns the new table contents; write it with :func:`overwrite` to a new location (a
    Parquet path that is being read cannot be overwritten in the same job), or, when the
    key is the partition column, write only ``source`` with :func:`replace_partitions`.
    """
    src = _unique_keys(source, keys)
    kept = target.join(src.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src.select(*target.columns))


def rewrite_table(spark: SparkSession, table: str, rows: DataFrame, location: str | None = None) -> None:
    """Give a catalog table new contents (and columns). An unpartitioned one: write ``rows`` to
    ``location``, a new folder beside the table's present one, then point the table at it. A
    partitioned one: :func:`meeple.operators.versions.rewrite`. Readers see the old contents until
    the last step, and a failed write leaves the table untouched. The old folder stays, readable by
    path."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        from meeple.operators import versions

        return versions.rewrite(spark, table, rows)
    if location is None:
        raise ValueError(f"{table} is not partitioned: name a new folder")
    names = {f.name: f.dataType for f in rows.schema.fields}
    have = {f.name: f.dataType for f in spark.table(table).schema.fields}
    rows.write.parquet(location)
    if names == have:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE {table}")  # external: the files stay
        spark.catalog.createTable(table, path=location, source="parquet")
    spark.catalog.refreshTable(table)


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], location: str) -> None:
    """S12 end to end on a catalog table: :func:`upsert`, written to ``location`` and swapped in by
    :func:`rewrite_table`. For a table partitioned by its key use :func:`replace_days`."""
    rewrite_table(spark, table, upsert(spark.table(table), source, keys), location)


# ------------------------------------------------------------------------- change feed


def _row_struct(prefix: str, columns: Sequence[str], change: Column) -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in columns], change.alias(CHANGE_TYPE))


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two versions of a table, tagged ``_change_type``:
    ``insert`` (key only in new), ``delete`` (key only in old), and for a key whose
    values changed an ``update_preimage`` row (old values) plus an ``update_postimage``
    row (new values). Unchanged rows are left out; NULLs compare equal.

    Keys must be unique within each version; a duplicate fails the job, since a change
    by key is undefined for it (and the join would pair every duplicate). One full outer
    join on the keys (sharing the shuffle of the uniqueness checks), then each joined row
    yields 0, 1 or 2 output rows through ``inline`` (no second pass over either version).
    """
    columns = list(new.columns)
    old = add_columns(old, {c: new.schema[c].dataType for c in columns if c not in old.columns})
    old, new = _unique_keys(old, keys), _unique_keys(new, keys)
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in columns], F.lit(True).alias("o_present"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in columns], F.lit(True).alias("n_present"))
    cond = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in keys]
    joined = o.join(n, cond, "full_outer")
    in_old, in_new = F.col("o_present").isNotNull(), F.col("n_present").isNotNull()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    changed = in_old & in_new & ~same
    pre = F.when(in_old & ~in_new, _row_struct("o_", columns, F.lit(DELETE))).when(
        changed, _row_struct("o_", columns, F.lit(UPDATE_PRE))
    )
    post = F.when(in_new & ~in_old, _row_struct("n_", columns, F.lit(INSERT))).when(
        changed, _row_struct("n_", columns, F.lit(UPDATE_POST))
    )
    images = F.filter(F.array(pre, post), lambda x: x.isNotNull())
    return joined.select(F.inline(images))


def apply_changes(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replay a change feed on the old version: drop deleted and pre-update rows, add
    inserted and post-update rows. ``apply_changes(old, changes(old, new)) == new``."""
    gone = feed.filter(F.col(CHANGE_TYPE).isin(DELETE, UPDATE_PRE)).select(*keys)
    added = feed.filter(F.col(CHANGE_TYPE).isin(INSERT, UPDATE_POST)).drop(CHANGE_TYPE)
    return old.join(gone, list(keys), "left_anti").unionByName(added.select(*old.columns))


WEIGHT = "_weight"


def signed(feed: DataFrame) -> DataFrame:
    """A change feed's rows with ``_weight``: +1 for a row that comes, -1 for one that goes."""
    sign = F.when(F.col(CHANGE_TYPE).isin(INSERT, UPDATE_POST), 1).otherwise(-1).cast("long")
    return feed.withColumn(WEIGHT, sign).drop(CHANGE_TYPE)


def bag_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change between two versions of a table without a key: each different row with ``_weight``,
    how many more times the new version has it (negative: fewer). One aggregate, combined
    map-side; rows that occur equally often cancel."""
    columns = list(new.columns)
    both = new.withColumn(WEIGHT, F.lit(1).cast("long")).unionByName(old.select(*columns).withColumn(WEIGHT, F.lit(-1).cast("long")))
    return both.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).filter(F.col(WEIGHT) != 0)


# ----------------------------------------------------------------------------- layout


def compacted(df: DataFrame, column: str, num_files: int) -> DataFrame:
    """OPTIMIZE of one day's rows: ``num_files`` partitions by ranges of ``column``, each
    sorted by it. Same rows; write the result to compact the table, whose files then hold
    (nearly) disjoint ranges of ``column``, so a filter on it skips the others by their footers.

    Ranges are cut on (column, row hash) with the column's full value, so ids with a common
    prefix are told apart, and a value that holds a large share of the rows is split over
    several files instead of filling one. The hash is deterministic: a retried task places every
    row exactly as before."""
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    return (
        df.withColumn("_h", row_hash)
        .repartitionByRange(num_files, column, "_h")
        .sortWithinPartitions(column, "_h")
        .drop("_h")
    )


def small_files(df: DataFrame, small_bytes: int, by: Sequence[str] = ()) -> DataFrame:
    """(by..., file, size, bin) of the files of a table (a plain scan) smaller than ``small_bytes``, of
    those groups ``by`` (partition columns) that have several. Bins are packed in order of size, up
    to about ``small_bytes`` each: running totals of a group's sizes, a few numbers a file."""
    files = df.select(*by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    # the scan gives a row a row; distinct is combined map-side to one a file and task
    low = files.filter(F.col("size") < small_bytes)
    order = Window.partitionBy(*by).orderBy("size", "file") if by else Window.orderBy("size", "file")
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    packed = low.withColumn("_n", F.count(F.lit(1)).over(whole)).filter("_n > 1")
    return packed.withColumn("bin", F.floor((F.sum("size").over(order) - F.col("size")) / small_bytes).cast("int")).drop("_n")


def compact_small_files(spark: SparkSession, path: str, small_bytes: int, partition_by: str | None = None) -> dict[str, int]:
    """S15 by file size: the files of a Parquet table below ``small_bytes`` are packed together, one new
    file for each bin of about that size; larger files, and groups with a single small one, are not
    touched and keep their names. Returns by how many files a partition value (or ``""``) has fewer.

    New files are written under a hidden name and moved in when complete, then the old ones go: a
    reader that lists the folder between these two steps sees rows twice, so run it when the table is
    not being read (or publish by :mod:`meeple.operators.versions`)."""
    table = spark.read.parquet(path)
    by = [partition_by] if partition_by else []
    found = small_files(table, small_bytes, by).collect()  # names of small files, as the driver's file listing has
    done: dict[str, int] = {}
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    groups: dict[tuple, list] = {}
    for r in found:
        groups.setdefault((r[by[0]] if by else None, r["bin"]), []).append(unquote(r["file"]))
    for (value, number), files in sorted(groups.items(), key=str):
        if len(files) < 2:
            continue
        folder = files[0].rsplit("/", 1)[0]
        hidden = f"{folder}/_compacted-{uuid.uuid4().hex}"
        spark.read.schema(table.drop(*by).schema).parquet(*files).coalesce(1).write.parquet(hidden)
        for status in fs.listStatus(fs_path(hidden)):
            if status.getPath().getName().startswith("part-"):
                fs.rename(status.getPath(), fs_path(folder, f"compacted-{status.getPath().getName()}"))
        for file in files:
            fs.delete(fs_path(file), False)
        fs.delete(fs_path(hidden), True)
        done[str(value) if by else ""] = done.get(str(value) if by else "", 0) + len(files) - 1
    return done


def clustered(df: DataFrame, column: str) -> DataFrame:
    """CLUSTER BY: rows with equal ``column`` next to each other, sorted within each
    partition. Uses a rebalancing shuffle so adaptive execution can split a key that holds
    a large share of the rows over several tasks instead of one."""
    return df.hint("rebalance", column).sortWithinPartitions(column)


# --------------------------------------------------------------------- schema changes


def add_columns(df: DataFrame, columns: dict[str, str | T.DataType]) -> DataFrame:
    """ALTER TABLE ADD COLUMNS: new columns read NULL on existing rows. On a stored table:
    ``rewrite_table(spark, table, add_columns(spark.table(table), ...), location)``."""
    return df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in columns.items()})


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """ALTER TABLE DROP COLUMN. On a stored table: :func:`rewrite_table` with the result."""
    return df.drop(*columns)
