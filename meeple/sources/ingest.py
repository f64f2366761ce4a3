"""Bronze ingest: typed appends, CRM-export ingest (columns suffixed ``__c``), and ingest with a
reject table for rows that do not fit the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from meeple.operators import tables
from meeple.sources.schemas import REQUIRED_COLUMNS, conform, schema_of

CRM_SUFFIX = "__c"
ERRORS = "_errors"


def typed(df: DataFrame, table: str) -> DataFrame:
    """Cast incoming rows to the table contract (ints, doubles, dates, timestamps)."""
    return conform(df, table)


def crm_export(df: DataFrame) -> DataFrame:
    """The CRM export shape of a table: every column suffixed ``__c``."""
    return df.select(*[F.col(c).alias(c + CRM_SUFFIX) for c in df.columns])


def from_crm(df: DataFrame, table: str) -> DataFrame:
    """Map a CRM export onto a raw table by column name (never by position).

    ``user_id__c`` becomes ``user_id`` and so on; columns the contract does not know are
    ignored, then the rows are cast to the contract.
    """
    wanted = {f.name for f in schema_of(table).fields}
    renamed = [
        F.col(c).alias(c[: -len(CRM_SUFFIX)])
        for c in df.columns
        if c.endswith(CRM_SUFFIX) and c[: -len(CRM_SUFFIX)] in wanted
    ]
    return conform(df.select(*renamed), table)


def append(df: DataFrame, path: str, table: str, partition_by: list[str] | None = None) -> None:
    """Append typed rows to a Parquet table, matched by name to the contract."""
    writer = typed(df, table).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def checked(df: DataFrame, table: str, required: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``df`` cast to the contract where that can be done, with ``_errors``: the columns that
    are broken (present, but not of the contract's type) or missing (``required`` and NULL or
    blank), in contract order; none for a good row. Broken cells are NULL; the source's cells are kept
    as text in a struct ``_source``. One projection: no second look at the source. ``keep``: further
    columns to keep as they are."""
    required = REQUIRED_COLUMNS.get(table, []) if required is None else required
    fields = schema_of(table).fields
    if missing := [f.name for f in fields if f.name not in df.columns]:
        raise ValueError(f"{table}: missing columns {missing}")
    cast, errors = [], []
    for f in fields:
        c = F.col(f.name)
        value = c if df.schema[f.name].dataType == f.dataType else _trimmed(c, df.schema[f.name].dataType).try_cast(f.dataType)
        cast.append(value.alias(f.name))
        broken = value.isNull() & c.isNotNull()
        if f.name in required:
            broken = broken | c.isNull() | (F.trim(c.cast("string")) == "")
        errors.append(F.when(broken, F.lit(f.name)))
    source = F.struct(*[F.col(f.name).cast("string").alias(f.name) for f in fields])
    return df.select(*cast, F.array_compact(F.array(*errors)).alias(ERRORS), source.alias("_source"), *(keep or []))


def _trimmed(c, kind: T.DataType):
    """Text without the blanks around it, as the cast of a whole column ignores them too."""
    return F.trim(c) if isinstance(kind, T.StringType) else c


def read_csv_checked(spark, path: str, table: str, required: list[str] | None = None) -> DataFrame:
    """S5 with rejects: an exported raw table (header line) as :func:`checked` rows. A line with too
    many or too few fields has the error ``_line`` and is kept whole in ``_source._line``."""
    names = [f.name for f in schema_of(table).fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
    reader = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
    rows = checked(reader.csv(path), table, required, keep=["_line"])
    bad = F.when(F.col("_line").isNotNull(), F.array(F.lit("_line"))).otherwise(F.array().cast("array<string>"))
    return rows.withColumn(ERRORS, F.concat(bad, ERRORS)).withColumn("_source", F.col("_source").withField("_line", F.col("_line"))).drop("_line")


def accepted(rows: DataFrame) -> DataFrame:
    """The good rows of :func:`checked`, in the contract's columns."""
    return rows.filter(F.size(ERRORS) == 0).drop(ERRORS, "_source")


def rejected(rows: DataFrame) -> DataFrame:
    """The other rows as they came, as text, with the broken columns' names in ``errors``."""
    return rows.filter(F.size(ERRORS) > 0).select("_source.*", F.concat_ws(",", ERRORS).alias("errors"))


def append_checked(
    df: DataFrame, path: str, rejects_path: str, table: str, partition_by: list[str] | None = None, required: list[str] | None = None
) -> tuple[int, int]:
    """Append the good rows to a Parquet table and the others to its reject table; returns how many
    of each. The source is read and cast once: the checked rows are stored, and both tables are
    written from there."""
    with tables.staging():
        rows = tables.stage(checked(df, table, required))
        good, bad = accepted(rows), rejected(rows)
        counts = rows.groupBy((F.size(ERRORS) == 0).alias("good")).count().collect()
        writer = good.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        bad.write.mode("append").parquet(rejects_path)
    n = {r["good"]: r["count"] for r in counts}
    return n.get(True, 0), n.get(False, 0)
