"""Top-k per group: the distributed form of ``ORDER BY ... LIMIT k`` per key.

``row_number() <= k`` over a window is planned by Spark with a group limit on each
map task before the shuffle, so the exchange carries at most ``k`` rows per group and
task however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    k: int = 1,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of each group by ``order`` (a total order: add tie-breaks)."""
    name = rank_col or "_rank"
    w = Window.partitionBy(*group_cols).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def top_by_count(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    count_col: str = "cnt",
    k: int = 1,
) -> DataFrame:
    """Most frequent ``value_col`` per group; ties go to the smaller value, NULL last.

    ``df`` holds per-(group, value) counts in ``count_col``.
    """
    order = [F.col(count_col).desc(), F.col(value_col).asc_nulls_last()]
    return top_per_group(df, group_cols, order, k)
