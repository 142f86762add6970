"""Connected components of a graph given by its edges, in joins and aggregates.

Large-star and small-star steps in turn bring every node to the smallest node of its
component; the number of rounds grows with the logarithm of the longest path. Every step
groups by node with a minimum, which each task reduces first, and joins that minimum back,
so a node with very many edges is split like any skewed join key. Each round is written to
the shared folder; nothing of the graph passes through the driver but two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.frames import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Nodes above ``u`` are tied to the smallest node that ``u`` knows."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    tied = both.join(least, "u").filter(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``u`` and the nodes below it are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return tied.filter(F.col("u") > F.col("v")).unionAll(own).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))
    ).first()
    return tuple(row)


def roots(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that is not the smallest of its component.

    ``edges`` has long columns ``u`` and ``v``; loops, repeated edges, NULL ends and either
    direction are allowed. Without edges the result is empty.
    """
    now = staged(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    before = _state(now)
    while before[0]:
        now = staged(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
