"""Enriching a fact with lookups, without fan-out.

No join is forced to broadcast. Spark broadcasts a lookup whose size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where
adaptive execution splits a key that holds too many fact rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_lookup(
    df: DataFrame, key: str, values: Mapping[str, str | Column]
) -> DataFrame:
    """One row per key: the largest value per column, or a given aggregate."""
    return df.groupBy(key).agg(
        *[
            (F.max(v) if isinstance(v, str) else v).alias(name)
            for name, v in values.items()
        ]
    )


def left_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Left join that adds columns of the lookup under the given names.

    ``on`` maps fact column to lookup column; ``take`` maps new name to lookup
    column, or lists names to take as they are.
    """
    taken = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    right = lookup.select(
        *[F.col(r).alias(f"__on_{r}") for r in on.values()],
        *[F.col(c).alias(f"__take_{n}") for n, c in taken.items()],
    )
    joined = fact.join(
        right, [F.col(l) == F.col(f"__on_{r}") for l, r in on.items()], "left"
    )
    return joined.select(
        *fact.columns, *[F.col(f"__take_{n}").alias(n) for n in taken]
    )
