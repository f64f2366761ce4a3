"""Raw game tables over the driver's test tables (``customer``, ``nation``, ``events``).

The test data has no game tables, so these views give rows in the raw-table schemas.
They only shape input; every job downstream runs unchanged on any data of these
schemas. They deliberately include the awkward cases the jobs must handle: NULL users,
NULL and out-of-range ages, repeated users, users who never spend, users with few or short
sessions, non-positive amounts, rank 0, mixed-case labels, several logins per user and day,
logins without a time, sessions without a login, sessions ending after midnight.

The DuckDB twin of each view lives in :mod:`meeple.oracle`.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.operators.sampling import DEVICE_TYPES, GAME_TYPES, GENDERS, ranked_sample

# Fixed parameters of the test runs.
RUN_DATE = dt.date(2024, 1, 15)
AS_OF = dt.date(2024, 1, 27)
SIGNUP_EPOCH = dt.date(2023, 10, 1)
LEADERBOARD_SEED = "lb"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: F.Column, labels: list[str]) -> F.Column:
    """labels[col % len(labels)] as a CASE expression."""
    key = F.pmod(col, F.lit(len(labels)))
    expr = F.when(key == 0, labels[0])
    for i, label in enumerate(labels[1:], start=1):
        expr = expr.when(key == i, label)
    return expr


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    # some users are listed twice
    listed = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(key % 53 == 0, 2).otherwise(1))))
    return listed.select(
        key.cast("string").alias("user_id"),
        F.when(F.col("copy") == 1, F.col("c_name")).otherwise(F.concat("c_name", F.lit("_2"))).alias("username"),
        F.col("n_name").alias("country"),
        F.date_add(F.lit(SIGNUP_EPOCH), F.pmod(key, F.lit(119)).cast("int")).alias("signup_date"),
        F.when(F.pmod(key, F.lit(41)) == 0, F.lit(None).cast("int"))
        .otherwise((F.pmod(key, F.lit(40)) + 10).cast("int"))
        .alias("age"),
        _case(key, GENDERS).alias("gender"),
    )


def raw_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    eid = F.col("event_id")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.pmod(eid, F.lit(31)) != 0, F.col("ts")).alias("timestamp"),
        _case(eid, DEVICE_TYPES).alias("device_type"),
        F.concat(F.lit("City_"), F.pmod(eid, F.lit(50)).cast("string")).alias("location"),
        F.col("ts").cast("date").alias("event_date"),
    )


def raw_game_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
    eid, uid = F.col("event_id"), F.col("user_id")
    # some users play rarely: most of their sessions go to the user before
    player = F.when((F.pmod(uid, F.lit(10)) == 3) & (F.pmod(eid, F.lit(16)) != 0), uid - 1).otherwise(uid)
    minutes = (F.pmod(eid, F.pmod(uid, F.lit(8)) * 8 + 1) + 2).cast("int")
    seconds = F.pmod(eid, F.lit(60)).cast("int")
    return ev.select(
        eid.cast("string").alias("session_id"),
        F.when(F.pmod(eid, F.lit(89)) == 0, F.lit(None).cast("string"))
        .otherwise(player.cast("string"))
        .alias("user_id"),
        _case(eid, GAME_TYPES).alias("game_type"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, seconds)).alias("end_time"),
        F.pmod(eid * 37, F.lit(1001)).cast("int").alias("score"),
        _case(eid, ["WIN", "lose"]).alias("result"),  # mixed case on purpose
        F.col("ts").cast("date").alias("event_date"),
    )


def raw_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    eid = F.col("event_id")
    return ev.select(
        eid.cast("string").alias("purchase_id"),
        F.when(F.pmod(eid, F.lit(97)) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        _case(eid, ["Skin", "Coins", "boost", "PASS"]).alias("item"),  # mixed case on purpose
        # one user in four spends; the others' amounts are refunds
        F.when(F.pmod("user_id", F.lit(4)) == 1, F.col("value") - 10).otherwise(-F.abs("value")).alias("amount"),
        F.col("ts").alias("timestamp"),
        F.col("ts").cast("date").alias("event_date"),
    )


def raw_leaderboard_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per game and day, 20 of that day's logged-in users in seeded order; rank 20 reads 0."""
    players = raw_logins(spark, sf_dir).select("user_id", "event_date").distinct()
    per_game = players.withColumn("game_type", F.explode(F.array(*[F.lit(g) for g in GAME_TYPES])))
    ranked = ranked_sample(
        per_game, ["game_type", "event_date"], ["user_id"], 20, LEADERBOARD_SEED, rank_col="rk"
    )
    return ranked.select(
        "user_id", "game_type", F.pmod(F.col("rk"), F.lit(20)).cast("int").alias("rank"), "event_date"
    )


class RawTables:
    """The five raw tables over one test-data folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    @cached_property
    def users(self) -> DataFrame:
        return raw_users(self._spark, self._dir)

    @cached_property
    def logins(self) -> DataFrame:
        return raw_logins(self._spark, self._dir)

    @cached_property
    def sessions(self) -> DataFrame:
        return raw_game_sessions(self._spark, self._dir)

    @cached_property
    def purchases(self) -> DataFrame:
        return raw_purchases(self._spark, self._dir)

    @cached_property
    def leaderboard(self) -> DataFrame:
        return raw_leaderboard_snapshots(self._spark, self._dir)


def load_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    """All five raw tables over one test-data folder (lazy: nothing is read yet)."""
    return RawTables(spark, sf_dir)
