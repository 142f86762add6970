"""Checks on finished tables: unique keys, nulls, lookup hits, matches, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; empty for a unique key."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def _number_of(condition: Column) -> Column:
    # NULL on an empty table, as a sum is.
    return F.sum(F.when(condition, 1).otherwise(0))


def null_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """NULLs per column; ``columns`` maps output name to column. One pass."""
    return df.agg(*[_number_of(F.col(c).isNull()).alias(n) for n, c in columns.items()])


def lookup_hits(
    df: DataFrame, columns: Mapping[str, str], total: str = "total_rows"
) -> DataFrame:
    """Rows in all, and rows that received each looked-up value. One pass."""
    return df.agg(
        F.count(F.lit(1)).alias(total),
        *[_number_of(F.col(c).isNotNull()).alias(n) for n, c in columns.items()],
    )


def match_counts(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str | None = None,
    names: tuple[str, str, str] = ("total_rows", "matched_rows", "unmatched_rows"),
) -> DataFrame:
    """Rows with and without a partner in the lookup.

    The rows are counted per key before the join, so each task ships a key once
    however many rows hold it. A key that the lookup repeats counts its rows once
    per partner, as a left join does.
    """
    partners = (
        lookup.select(F.col(lookup_key or key).alias("__key"))
        .filter(F.col("__key").isNotNull())
        .groupBy("__key")
        .agg(F.count(F.lit(1)).alias("__partners"))
    )
    rows = df.groupBy(F.col(key).alias("__row_key")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    joined = rows.join(partners, F.col("__row_key") == F.col("__key"), "left")
    matched = F.sum(
        F.when(F.col("__key").isNotNull(), F.col("__rows") * F.col("__partners"))
        .otherwise(0)
    )
    unmatched = F.sum(F.when(F.col("__key").isNull(), F.col("__rows")).otherwise(0))
    return joined.agg(
        F.coalesce(matched + unmatched, F.lit(0)).alias(names[0]),
        matched.alias(names[1]),
        unmatched.alias(names[2]),
    )


def unmatched_rows(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None
) -> DataFrame:
    """The rows without a partner in the lookup."""
    keys = lookup.select(F.col(lookup_key or key).alias("__key"))
    return df.join(keys, F.col(key) == F.col("__key"), "left_anti")


def coverage(
    dimension: DataFrame,
    key: str,
    branches: Mapping[str, tuple[DataFrame, str, str]],
) -> DataFrame:
    """Distinct members per dimension row in each branch, zero where there are none.

    ``branches`` maps output name to (frame, key column, member column). Each branch
    is reduced to its distinct members, which also lets Spark drop lookup joins the
    branch does not need; then all branches are counted in one aggregate by key.
    """
    tagged = [
        frame.select(
            F.col(branch_key).alias("__key"), F.col(member).cast("string").alias("__member")
        )
        .filter(F.col("__key").isNotNull() & F.col("__member").isNotNull())
        .distinct()
        .select(F.lit(name).alias("__branch"), "__key")
        for name, (frame, branch_key, member) in branches.items()
    ]
    counts = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("__key")
        .agg(*[F.count_if(F.col("__branch") == n).alias(n) for n in branches])
    )
    return dimension.join(counts, dimension[key] == counts["__key"], "left").select(
        dimension["*"], *[F.coalesce(n, F.lit(0)).alias(n) for n in branches]
    )
