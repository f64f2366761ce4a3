"""Compare a Spark result with a DuckDB result: row count, column names and types, and the
order-insensitive bag of exact values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from dataclasses import dataclass, field

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date, bool, int, str)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


_SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


@dataclass
class Comparison:
    name: str
    spark_rows: int
    duck_rows: int
    columns_match: bool
    types_match: bool
    values_match: bool
    notes: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.columns_match and self.values_match and self.spark_rows == self.duck_rows


def compare(name: str, spark_df, con, sql: str) -> Comparison:
    s_cols = spark_df.columns
    s_types = [f.dataType.simpleString() for f in spark_df.schema.fields]
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    notes = []
    columns_match = sorted(s_cols) == sorted(d_cols)
    if not columns_match:
        notes.append(f"columns spark={s_cols} duck={d_cols}")
    s_map = {c: _SPARK_TO_DUCK.get(t, t) for c, t in zip(s_cols, s_types)}
    d_map = dict(zip(d_cols, d_types))
    type_diff = {c: (s_map.get(c), d_map.get(c)) for c in s_map if s_map.get(c) != d_map.get(c)}
    if type_diff:
        notes.append(f"types {type_diff}")
    a, b = canonical(s_cols, s_rows), canonical(d_cols, d_rows)
    values_match = a == b
    if not values_match:
        sa, sb = set(a), set(b)
        only_s, only_d = sorted(sa - sb)[:3], sorted(sb - sa)[:3]
        notes.append(f"only spark {only_s}")
        notes.append(f"only duck {only_d}")
    return Comparison(name, len(s_rows), len(d_rows), columns_match, not type_diff, values_match, notes)
