"""A user holding a third of all rows: gold stays pair-free and exact."""

import datetime as dt

from pyspark.sql import functions as F

from meeple.plans import gold, silver
from meeple.sources import schemas
from tests.test_semantics import ntz

D = dt.date(2024, 3, 1)
N_SESSIONS = 60_000
HOT_SHARE = 3  # every third session belongs to the hot user
HOT_LOGINS = 1_000


def skewed(spark):
    ids = spark.range(N_SESSIONS)
    user = F.when(F.col("id") % HOT_SHARE == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
    start = F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (F.col("id") % 24).cast("int"), F.lit(0), F.lit(0)
    )
    sessions = ids.select(
        F.col("id").cast("string").alias("session_id"), user.alias("user_id"), F.lit("Arcade").alias("game_type"),
        start.alias("start_time"), (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10))).alias("end_time"),
        F.lit(1).alias("score"), F.lit("Win").alias("result"), F.lit(D).alias("event_date"),
    )
    logins = spark.range(HOT_LOGINS).select(
        F.lit("hot").alias("user_id"), F.lit(dt.datetime(2024, 3, 1, 1)).cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("id") % 4 == 0, "Web").otherwise("iOS").alias("device_type"),
        F.lit("X").alias("location"), F.lit(D).alias("event_date"),
    )
    purchases = spark.createDataFrame([], ntz(schemas.RAW_PURCHASES))
    return sessions, logins, purchases


def hot_users(spark, copies=1):
    return spark.createDataFrame([("hot", f"n{i}", "C", D, 20, "Male") for i in range(copies)], schemas.RAW_USERS)


def test_hot_user_collapses_before_the_join(spark):
    sessions, logins, _ = skewed(spark)
    cells = gold.weighted_session_cells(sessions, logins, hot_users(spark))
    hot_rows = cells.filter(F.col("user_id") == "hot").count()
    assert hot_rows <= 24 * 2  # hours x devices, not sessions x logins


def test_skewed_day_summary_is_exact(spark):
    sessions, logins, purchases = skewed(spark)
    row = gold.daily_summary(sessions, logins, purchases, hot_users(spark), D).collect()[0]
    hot = N_SESSIONS // HOT_SHARE
    # brute force: each hot session appears once per hot login, every other session once
    assert row["total_sessions"] == hot * HOT_LOGINS + (N_SESSIONS - hot)
    assert row["avg_session_duration"] == 10.0
    assert row["top_device_type"] == "Ios"  # 750 of the 1000 logins
    assert row["unique_active_users"] == 1 + sessions.filter(F.col("user_id") != "hot").select("user_id").distinct().count()
    demo = gold.user_demographics(hot_users(spark), sessions, logins, purchases).first()
    assert demo["total_sessions"] == hot * HOT_LOGINS


def test_one_login_silver_is_linear(spark):
    sessions, logins, _ = skewed(spark)
    assert silver.user_sessions(sessions, hot_users(spark), logins, D, one_login_per_day=True).count() == N_SESSIONS


def test_a_user_day_hot_on_both_sides_is_split(spark):
    """10^5 sessions x 10^3 logins of one user and day, beside small keys: same rows, in tasks of
    like size."""
    n, hot_logins = 100_000, 1000
    ids = spark.range(n + 4000)
    start = F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz")
    user = F.when(F.col("id") < n, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    sessions = ids.select(
        F.col("id").cast("string").alias("session_id"), user.alias("user_id"), F.lit("Arcade").alias("game_type"), start.alias("start_time"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10))).alias("end_time"), F.lit(1).alias("score"), F.lit("Win").alias("result"),
        F.lit(D).alias("event_date"),
    )
    logins = spark.range(hot_logins + 300).select(
        F.when(F.col("id") < hot_logins, F.lit("hot")).otherwise((F.col("id") % 300).cast("string")).alias("user_id"),
        start.alias("timestamp"), F.lit("Web").alias("device_type"), F.concat(F.lit("L"), F.col("id").cast("string")).alias("location"),
        F.lit(D).alias("event_date"),
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        whole = silver.user_sessions(sessions, hot_users(spark), logins, cell_rows=50_000)
        sizes = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
        want = n * hot_logins + silver.user_sessions(sessions.filter("user_id IS NULL OR user_id <> 'hot'"), hot_users(spark), logins).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == want
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def test_split_and_plain_joins_give_the_same_rows(spark):
    sessions, logins, _ = skewed(spark)
    some, few = sessions.filter(F.col("session_id").cast("long") % 40 == 0), logins.limit(40)
    split = silver.user_sessions(some, hot_users(spark, 2), few, cell_rows=100)
    plain = silver.user_sessions(some, hot_users(spark, 2), few)
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
