"""Joins on keys that are hot on both sides.

Adaptive execution splits a hot partition of one side and gives every piece the whole other side;
where both sides are large under one key, each piece is still a large product. Here the hot keys
are found by counting, and their pairs are dealt into cells of about equal size: a left row goes to
one cell of its key by a hash, a right row to all of them. Other keys are left as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meeple.operators import tables

CELLS = "_cells"
#: More heavy keys than this are joined without a broadcast hint.
MAX_BROADCAST_KEYS = 10_000


def heavy_keys(left: DataFrame, right: DataFrame, on: dict[str, str], cell_rows: int) -> DataFrame:
    """Left key columns and ``_cells`` of the keys with more than ``cell_rows`` pairs: as many cells
    as hold about that many each, but no more than left rows. Both counts are combined
    map-side. Copying a right row to all cells then makes at most as many rows as the join does."""
    l_names, r_names = list(on), list(on.values())
    lefts = left.groupBy(*l_names).agg(F.count(F.lit(1)).alias("_n_left"))
    rights = right.groupBy(*r_names).agg(F.count(F.lit(1)).alias("_n_right"))
    pairs = F.col("_n_left").cast("decimal(38,0)") * F.col("_n_right")
    both = lefts.join(rights, [F.col(a) == F.col(b) for a, b in on.items()])
    cells = F.least(F.col("_n_left"), F.ceil(pairs / F.lit(cell_rows)).cast("long"))
    return both.filter(pairs > cell_rows).select(*l_names, cells.cast("int").alias(CELLS)).filter(F.col(CELLS) > 1)


def split_left_join(
    left: DataFrame, right: DataFrame, on: dict[str, str], spread_by: Sequence[str], cell_rows: int, also: Column | None = None
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on left column == right column for each of ``on`` (and ``also``, a
    condition on left rows), with heavy keys split. All columns of both sides. ``spread_by``: left
    columns whose hash tells the rows of a key apart; by a hash, so a retried task deals alike."""
    heavy = tables.stage(heavy_keys(left if also is None else left.filter(also), right, on, cell_rows))
    matches = F.lit(True) if also is None else also
    for a, b in on.items():
        matches = matches & (F.col(a) == F.col(b))
    n = heavy.count()
    if n == 0:
        return left.join(right, matches, "left")
    small = F.broadcast if n <= MAX_BROADCAST_KEYS else lambda df: df
    keys = heavy.select(*[F.col(a).alias(f"_h{i}") for i, a in enumerate(on)], CELLS)

    def dealt(df: DataFrame, names: Sequence[str]) -> DataFrame:
        same = [F.col(c) == F.col(f"_h{i}") for i, c in enumerate(names)]
        return df.join(small(keys), same, "left").withColumn(CELLS, F.coalesce(CELLS, F.lit(1))).drop(*[f"_h{i}" for i in range(len(names))])

    lefts = dealt(left, list(on)).withColumn("_cell", F.pmod(F.xxhash64(*spread_by), F.col(CELLS)).cast("int")).drop(CELLS)
    rights = dealt(right, list(on.values())).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col(CELLS) - 1))).drop(CELLS)
    return lefts.join(rights, matches & (F.col("_cell") == F.col("_copy")), "left").drop("_cell", "_copy")
