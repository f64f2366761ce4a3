"""Silver layer: enriched sessions, purchases and leaderboard rows (Q1-Q3).

Each function takes the raw tables and an optional ``run_date``; with a date it returns
that day only (the daily job), without it every day (a backfill). The date filter is
written once on the fact table; Catalyst copies it to the other side of each join
through the join keys and down to the Parquet scans.

Joins are plain equi-joins without hints. Spark broadcasts a side only when its size
is known to be below ``spark.sql.autoBroadcastJoinThreshold`` (statically or, with
adaptive execution, from the actual shuffle size) and falls back to a sort-merge join
otherwise, so a user table that grows with the business never has to fit in memory.
Adaptive skew handling splits a hot user on the fact side, and :mod:`meeple.operators.skew` a
(user, day) that is hot on both sides. Rows without a user can match nothing: their join key is a
spread stand-in that the join condition rules out, so they neither meet in one task nor need a
second scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.functions.exprs import duration_minutes, money, normalise_label, title_case
from meeple.operators.skew import split_left_join
from meeple.sources.readers import day

USER_ATTRS = ["user_id", "age", "gender", "country"]
_STAND_INS = 1024


def earliest_login_per_day(logins: DataFrame) -> DataFrame:
    """One login per (user, day): the earliest (one without a time only if there is no other),
    ties broken by device then location.

    Aggregates with a partial (map-side) step, so a user with millions of logins ships
    one row per map task.
    """
    order = [F.col("timestamp").isNull(), F.col("timestamp"), F.col("device_type").isNull(), F.col("device_type"),
             F.col("location").isNull(), F.col("location")]
    names = ["no_time", "timestamp", "no_device", "device_type", "no_location", "location"]
    first = F.min(F.struct(*[c.alias(n) for c, n in zip(order, names)])).alias("first")
    return logins.groupBy("user_id", "event_date").agg(first).select(
        "user_id", "event_date", "first.device_type", "first.location"
    )


def user_sessions(
    sessions: DataFrame,
    users: DataFrame,
    logins: DataFrame,
    run_date: dt.date | str | None = None,
    one_login_per_day: bool = False,
    cell_rows: int | None = None,
) -> DataFrame:
    """Q1: sessions with user attributes, the day's login device and location, duration.

    Like the reference, a session matches every login of its user on its day, so a
    user with k logins that day yields k rows per session (``one_login_per_day=True``
    keeps only the earliest login and gives exactly one row per session). Sessions
    without a login keep NULL device and location.

    ``cell_rows``: a (user, day) whose sessions times logins are more than that is split over
    several tasks (:func:`meeple.operators.skew.split_left_join`; it counts both sides first).
    """
    if run_date is not None:
        sessions = day(sessions, run_date)
    login_side = (
        earliest_login_per_day(logins)
        if one_login_per_day
        else logins.select("user_id", "event_date", "device_type", "location")
    )
    # a stand-in for a NULL user, spread over many values; the condition keeps it from matching
    stand_in = F.concat(F.lit("-"), F.pmod(F.xxhash64("session_id"), F.lit(_STAND_INS)).cast("string"))
    keyed = sessions.withColumn("_user", F.coalesce("user_id", stand_in))
    known = F.col("user_id").isNotNull()
    attributes = users.select(F.col("user_id").alias("_listed"), *USER_ATTRS[1:])
    joined = keyed.join(attributes, (F.col("_user") == F.col("_listed")) & known, "left")
    login_side = login_side.select(F.col("user_id").alias("_logged"), F.col("event_date").alias("_day"), "device_type", "location")
    on = {"_user": "_logged", "event_date": "_day"}
    if cell_rows is None:
        matches = (F.col("_user") == F.col("_logged")) & (F.col("event_date") == F.col("_day")) & known
        joined = joined.join(login_side, matches, "left")
    else:
        joined = split_left_join(joined, login_side, on, ["session_id"], cell_rows, known)
    return joined.select(
        "session_id",
        "user_id",
        "game_type",
        "start_time",
        "end_time",
        duration_minutes("start_time", "end_time").cast("double").alias("session_duration_minutes"),
        "score",
        normalise_label("result").alias("result"),
        "age",
        "gender",
        "country",
        normalise_label("device_type").alias("login_device"),
        F.col("location").alias("login_location"),
        "event_date",
    )


def valid_purchases(purchases: DataFrame) -> DataFrame:
    """Purchases of a known user with a positive amount, amounts rounded to cents."""
    valid = purchases.filter(F.col("user_id").isNotNull() & (F.col("amount") > 0))
    return valid.withColumn("amount", money("amount").cast("double"))


def purchases_enriched(
    purchases: DataFrame, users: DataFrame, run_date: dt.date | str | None = None
) -> DataFrame:
    """Q2: valid purchases (known user, positive amount) with user attributes."""
    if run_date is not None:
        purchases = day(purchases, run_date)
    joined = valid_purchases(purchases).join(users.select(*USER_ATTRS, "signup_date"), "user_id", "left")
    return joined.select(
        "purchase_id",
        "user_id",
        title_case("item").alias("item"),
        "amount",
        "timestamp",
        "age",
        "gender",
        "country",
        "signup_date",
        "event_date",
    )


def leaderboard_enriched(
    leaderboard: DataFrame,
    users: DataFrame,
    sessions: DataFrame,
    run_date: dt.date | str | None = None,
) -> DataFrame:
    """Q3: valid leaderboard rows with user attributes and the score of each session the
    player played in that game that day (one row per such session, NULL score if none)."""
    if run_date is not None:
        leaderboard = day(leaderboard, run_date)
    valid = leaderboard.filter(F.col("user_id").isNotNull() & (F.col("rank") > 0))
    # The leaderboard is tiny (20 players per game and day) and the preserved side of the
    # left joins, which Spark can never broadcast. So the large sides are first cut down
    # to its keys with semi joins (the key sets are small enough for Spark's size estimate
    # to broadcast them), and neither all users nor all sessions get shuffled for a few
    # rows. Only matching keys can contribute to a left join, so the result is unchanged.
    cell = ["user_id", "game_type", "event_date"]
    needed_users = users.select(*USER_ATTRS).join(valid.select("user_id").distinct(), "user_id", "left_semi")
    scores = sessions.select(*cell, "score").join(valid.select(*cell).distinct(), cell, "left_semi")
    joined = valid.join(needed_users, "user_id", "left").join(scores, cell, "left")
    return joined.select(
        "user_id", "game_type", "rank", "score", "age", "gender", "country", "event_date"
    )
