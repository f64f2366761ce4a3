"""Reproducible samples of given rows.

Every draw is a pure function of the row's key and a seed: ``md5(key | seed)`` read as a
32-bit number. Results do not depend on partitioning, executor count or retries, so a
lost executor recomputes exactly the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TWO_32 = 2**32

# Fixed values of the reference: label sets, the share of users drawn for a day's logins, and the
# players drawn per game and day.
DEVICE_TYPES = ["iOS", "Android", "Web"]
GAME_TYPES = ["Arcade", "Ranked", "Practice"]
GENDERS = ["Male", "Female", "Other"]
LOGIN_RATE = 0.80
LEADERBOARD_SIZE = 20


def key_hash(keys: Sequence[Column | str], seed: str | int | Column) -> Column:
    """An unsigned 32-bit draw from ``md5(k1|k2|...|seed)`` (BIGINT in [0, 2**32))."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    seed_col = seed if isinstance(seed, Column) else F.lit(str(seed))
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], seed_col.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def bernoulli(df: DataFrame, keys: Sequence[str], p: float, seed: str | int) -> DataFrame:
    """Keep each row with probability ``p``, decided by its key (G1)."""
    return df.filter(key_hash(keys, seed) < F.lit(int(p * _TWO_32)))


def ranked_sample(
    df: DataFrame,
    group_cols: Sequence[str],
    key_cols: Sequence[str],
    n: int,
    seed: str | int,
    rank_col: str = "rank",
) -> DataFrame:
    """Up to ``n`` rows per group without replacement, ranked 1..n in draw order.

    The order is ``md5(key | group | seed)`` with the key as tie-break. Spark plans
    ``row_number() <= n`` with a per-partition group limit before the shuffle, so a huge
    group ships at most ``n`` rows per map task.
    """
    order = F.md5(
        F.concat_ws(
            "|", *[F.col(c).cast("string") for c in [*key_cols, *group_cols]], F.lit(str(seed))
        )
    )
    w = Window.partitionBy(*group_cols).orderBy(order, *[F.col(c) for c in key_cols])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
