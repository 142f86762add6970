"""Dense ranks and top rows.

A ranking window gathers each group in one task. Here the distinct order values of all
groups are dealt by ranges of (group, value), so a group of any size and of any values is
spread over as many tasks as it fills; a value's rank is its place in its range, moved by
the number of values that its group has in the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.tables import stage

_PLACE, _RANGE, _MOVE = "__place", "__range", "__move"
#: Ids that grow by one within a task hold the task's number above these bits.
_TASK_BITS = 33


def _sort(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.col(c).asc() if way == "asc" else F.col(c).desc() for c, way in order]


def placed_values(
    df: DataFrame, groups: Sequence[str], order: Sequence[tuple[str, str]]
) -> DataFrame:
    """Distinct order values by group, in order, with their range and place in it.

    Written once, since another plan of the same values could draw other ranges.
    """
    values = df.select(*groups, *[c for c, _ in order]).distinct()
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(g).asc() for g in groups], *_sort(order)]
    dealt = values.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    written = stage(dealt.withColumn(_PLACE, F.monotonically_increasing_id()), "ranks")
    return written.withColumn(_RANGE, F.shiftright(_PLACE, _TASK_BITS))


def dense_rank(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[tuple[str, str]],
    name: str = "rank",
) -> DataFrame:
    """Rank rows within their group; equal order values share a rank.

    ``order`` lists ``(column, "asc" | "desc")``; NULL sorts first ascending and last
    descending. Runs one job, which writes the distinct values; a window then holds one
    row for each range that a group has, of which there are at most the shuffle
    partitions. Rows find their rank by an equality join.
    """
    values = placed_values(df, groups, order)
    sizes = values.groupBy(*groups, _RANGE).agg(
        F.count(F.lit(1)).alias("size"), F.min(_PLACE).alias("first")
    )
    until = Window.partitionBy(*groups).orderBy(_RANGE)
    before = F.sum("size").over(until) - F.col("size")
    moves = sizes.select(*groups, _RANGE, (before - F.col("first") + 1).alias(_MOVE))
    ranks = _join_null_safe(values, moves, [*groups, _RANGE], "inner").select(
        *groups, *[c for c, _ in order], (F.col(_PLACE) + F.col(_MOVE)).cast("int").alias(name)
    )
    return _join_null_safe(df, ranks, [*groups, *[c for c, _ in order]], "inner")


def dense_rank_by_window(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[tuple[str, str]],
    name: str = "rank",
) -> DataFrame:
    """The same by one window, for groups that are known to be small."""
    window = Window.partitionBy(*groups).orderBy(*_sort(order))
    return df.withColumn(name, F.dense_rank().over(window))


def _join_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str
) -> DataFrame:
    renamed = right.withColumnsRenamed({c: f"__on_{c}" for c in on})
    same = reduce(
        and_, [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on]
    )
    return left.join(renamed, same, how).drop(*[f"__on_{c}" for c in on])


def top(df: DataFrame, by: Sequence[tuple[str, str]], n: int) -> DataFrame:
    """First ``n`` rows; each task keeps its own ``n``. NULL sorts last."""
    keys = [
        F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in by
    ]
    return df.orderBy(*keys).limit(n)
