"""Table contracts (the DDL of the raw, silver and gold tables) and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event times are wall-clock times without a zone (as written in the exports and the
# Parquet files), so the contracts use TIMESTAMP_NTZ: text parses to exactly the time
# written, and hours, days and durations do not depend on the session time zone.
S, I, L, D, DT, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


RAW_USERS = _struct(
    ("user_id", S), ("username", S), ("country", S), ("signup_date", DT), ("age", I), ("gender", S)
)
RAW_LOGINS = _struct(
    ("user_id", S), ("timestamp", TS), ("device_type", S), ("location", S), ("event_date", DT)
)
RAW_GAME_SESSIONS = _struct(
    ("session_id", S), ("user_id", S), ("game_type", S), ("start_time", TS), ("end_time", TS),
    ("score", I), ("result", S), ("event_date", DT),
)
RAW_PURCHASES = _struct(
    ("purchase_id", S), ("user_id", S), ("item", S), ("amount", D), ("timestamp", TS), ("event_date", DT)
)
RAW_LEADERBOARD_SNAPSHOTS = _struct(("user_id", S), ("game_type", S), ("rank", I), ("event_date", DT))
SILVER_USER_SESSIONS = _struct(
    ("session_id", S), ("user_id", S), ("game_type", S), ("start_time", TS), ("end_time", TS),
    ("session_duration_minutes", D), ("score", I), ("result", S), ("age", I), ("gender", S),
    ("country", S), ("login_device", S), ("login_location", S), ("event_date", DT),
)
SILVER_PURCHASES_ENRICHED = _struct(
    ("purchase_id", S), ("user_id", S), ("item", S), ("amount", D), ("timestamp", TS), ("age", I),
    ("gender", S), ("country", S), ("signup_date", DT), ("event_date", DT),
)
SILVER_LEADERBOARD_ENRICHED = _struct(
    ("user_id", S), ("game_type", S), ("rank", I), ("score", I), ("age", I), ("gender", S),
    ("country", S), ("event_date", DT),
)
GOLD_DAILY_SUMMARY = _struct(
    ("event_date", DT), ("total_sessions", I), ("avg_session_duration", D), ("unique_active_users", I),
    ("total_revenue", D), ("avg_purchase_amount", D), ("top_device_type", S), ("peak_hour", I),
)
# The DDL with the later ADD COLUMNS (user_segment) applied.
GOLD_USER_DEMOGRAPHICS = _struct(
    ("user_id", S), ("gender", S), ("age_bracket", S), ("country", S), ("total_sessions", I),
    ("avg_session_duration", D), ("total_spent", D), ("num_purchases", I), ("user_segment", S),
)
# What the segmentation job writes (schema replaced on overwrite): counts are BIGINT and the
# registration date and account age are kept.
GOLD_USER_DEMOGRAPHICS_WRITTEN = _struct(
    ("user_id", S), ("gender", S), ("age_bracket", S), ("country", S), ("registration_date", DT),
    ("total_sessions", L), ("avg_session_duration", D), ("total_spent", D), ("num_purchases", L),
    ("user_age_days", I), ("user_segment", S),
)
GOLD_USER_SEGMENTS = _struct(
    ("user_id", S), ("gender", S), ("age_bracket", S), ("country", S), ("total_sessions", L),
    ("avg_session_duration", D), ("total_spent", D), ("num_purchases", L), ("user_segment", S),
)

SCHEMAS: dict[str, T.StructType] = {
    "raw_users": RAW_USERS,
    "raw_logins": RAW_LOGINS,
    "raw_game_sessions": RAW_GAME_SESSIONS,
    "raw_purchases": RAW_PURCHASES,
    "raw_leaderboard_snapshots": RAW_LEADERBOARD_SNAPSHOTS,
    "silver_user_sessions": SILVER_USER_SESSIONS,
    "silver_purchases_enriched": SILVER_PURCHASES_ENRICHED,
    "silver_leaderboard_enriched": SILVER_LEADERBOARD_ENRICHED,
    "gold_daily_summary": GOLD_DAILY_SUMMARY,
    "gold_user_demographics": GOLD_USER_DEMOGRAPHICS,
    "gold_user_demographics_written": GOLD_USER_DEMOGRAPHICS_WRITTEN,
    "gold_user_segments": GOLD_USER_SEGMENTS,
}

# Physical layout of each table: fact tables are partitioned by day so that the daily
# jobs prune partitions (the reference partitioned some of them by game or item, which
# no daily filter can prune).
PARTITION_COLUMNS: dict[str, list[str]] = {
    "raw_logins": ["event_date"],
    "raw_game_sessions": ["event_date"],
    "raw_purchases": ["event_date"],
    "raw_leaderboard_snapshots": ["event_date"],
    "silver_user_sessions": ["event_date"],
    "silver_purchases_enriched": ["event_date"],
    "silver_leaderboard_enriched": ["event_date"],
    "gold_daily_summary": ["event_date"],
}

# Columns without which a raw row is of no use: ingest with rejects turns such rows away.
REQUIRED_COLUMNS: dict[str, list[str]] = {
    "raw_users": ["user_id"],
    "raw_logins": ["user_id", "event_date"],
    "raw_game_sessions": ["session_id", "event_date"],
    "raw_purchases": ["purchase_id", "event_date"],
    "raw_leaderboard_snapshots": ["user_id", "game_type", "event_date"],
}


def schema_of(table: str) -> T.StructType:
    """The contract of a table."""
    try:
        return SCHEMAS[table]
    except KeyError:
        raise KeyError(f"unknown table {table!r}; known: {sorted(SCHEMAS)}") from None


def _is_timestamp(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the contract columns by name, in contract order, cast to contract types.

    Strings become dates and timestamps by parsing; a timestamp of either flavour
    (with or without zone) is kept as it is, so wall-clock values never shift.
    Missing contract columns raise.
    """
    schema = schema_of(table)
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in actual]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    cols = []
    for field in schema.fields:
        src, want = actual[field.name], field.dataType
        c = F.col(field.name)
        if _is_timestamp(want) and _is_timestamp(src):
            cols.append(c)
        elif isinstance(want, T.TimestampNTZType):
            cols.append(F.to_timestamp_ntz(c).alias(field.name))
        elif _is_timestamp(want):
            cols.append(F.to_timestamp(c).alias(field.name))
        elif isinstance(want, T.DateType) and not isinstance(src, T.DateType):
            cols.append(F.to_date(c).alias(field.name))
        elif src == want:
            cols.append(c)
        else:
            cols.append(c.cast(want).alias(field.name))
    return df.select(*cols)


def contract_violations(df: DataFrame, table: str, allow_extra: bool = False) -> list[str]:
    """Differences between a frame's schema and a table contract (empty list: conforms)."""
    problems = []
    schema = schema_of(table)
    actual = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in actual:
            problems.append(f"missing column {field.name}")
            continue
        got, want = actual[field.name], field.dataType
        if got != want and not (_is_timestamp(got) and _is_timestamp(want)):
            problems.append(f"{field.name}: {got.simpleString()} is not {want.simpleString()}")
    if not allow_extra:
        wanted = {f.name for f in schema.fields}
        problems += [f"unexpected column {c}" for c in actual if c not in wanted]
    return problems


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """DESCRIBE TABLE: (column, type) pairs of a frame's schema (metadata only, no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
