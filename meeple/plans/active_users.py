"""Distinct users over any span of days, exactly, from mergeable daily bitmaps (A3).

Daily counts of distinct users cannot be added up. Here every user has a stored dense number; the
users of a day are bits, in bitmaps of 32,768 numbers each (a 4 KB cell per day and bucket). The
users of a span are the OR of its days' cells, so a weekly or monthly figure reads and shuffles
cells, never a user id. A window of 30 days is the OR of five windows of 7: overlaps do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.operators import tables

#: Users numbered by one task.
USERS_PER_BLOCK = 1 << 16


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, number) of the users that ``known`` (an earlier result) has not got: dense numbers
    from 1, or on from its largest. Append them to the stored table.

    Users are dealt into blocks by a hash and numbered inside; a block starts where those before it
    end. The same users get the same numbers, however the job is split."""
    fresh = users.select("user_id").filter("user_id IS NOT NULL").distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known.select("user_id"), "user_id", "left_anti")
        first = known.agg(F.max("number")).first()[0] or 0
    fresh = tables.stage(fresh)
    blocks = max(1, -(-fresh.count() // USERS_PER_BLOCK))
    dealt = fresh.withColumn("_block", F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int"))
    # one row a block: the running total is a window over those
    sizes = dealt.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.selectExpr("_block", "sum(_size) OVER (ORDER BY _block) - _size AS _start")
    placed = dealt.selectExpr("user_id", "_block", "row_number() OVER (PARTITION BY _block ORDER BY user_id) AS _place")
    return placed.join(starts, "_block").select("user_id", (F.lit(first) + F.col("_start") + F.col("_place")).cast("long").alias("number"))


def day_bitmaps(activity: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date, bucket, bits) of the users with a row in ``activity`` (user_id, event_date). Each
    user counts once a day before the join; users without a number do not count."""
    seen = activity.select("user_id", "event_date").filter("user_id IS NOT NULL AND event_date IS NOT NULL").distinct()
    return seen.join(numbers, "user_id").groupBy("event_date", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def widened(bitmaps: DataFrame, have: int, want: int) -> DataFrame:
    """Bitmaps of windows of ``want`` days from those of ``have`` days, each named by its last day."""
    steps = sorted({*range(0, want - have, have), want - have})
    later = F.explode(F.array(*[F.lit(s) for s in steps]))
    return (
        bitmaps.withColumn("_later", later).withColumn("event_date", F.date_add("event_date", F.col("_later")))
        .groupBy("event_date", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    )


def _users(bitmaps: DataFrame, name: str) -> DataFrame:
    return bitmaps.groupBy("event_date").agg(F.sum(F.bitmap_count("bits")).alias(name))


def users_of_span(bitmaps: DataFrame, first_day, last_day) -> int:
    """Distinct users from ``first_day`` to ``last_day``, both included."""
    span = bitmaps.filter(F.col("event_date").between(F.lit(first_day), F.lit(last_day)))
    merged = span.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))).first()[0]


def rolling_users(bitmaps: DataFrame, week: int = 7, month: int = 30) -> DataFrame:
    """Per day with activity: its distinct users, and those of the ``week`` and ``month`` days that
    end with it."""
    weeks = widened(bitmaps, 1, week)
    out = _users(bitmaps, "users_1d")
    return out.join(_users(weeks, "users_7d"), "event_date").join(_users(widened(weeks, week, month), "users_30d"), "event_date")
