"""One row per business key, with the duplicates counted and classified.

The kept row is the one with the smallest content hash. It is found by an
aggregate, not by a window: every map task first reduces its rows to one per key,
so a key that holds a large share of the table is never gathered in one task.

Two forms: ``deduplicate`` carries the whole row through the aggregate and needs no
stage. For wide rows ``choose_rows`` aggregates fixed-width numbers only, the hash and
the place of a row in a stage (``placed``), and ``chosen_rows`` fetches the chosen ones
afterwards, by places, which no key can make uneven: a bit for each place is sent to the
rows, so whole rows are not moved at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import (
    CONFLICT,
    CONTENT,
    COPIES,
    HASH,
    HELPERS,
    LINEAGE_COLUMNS,
    PLACE,
    content_columns,
    record_key,
    row_hash,
)
from strata.operators.quality import Dataset
from strata.sources.tables import stage

#: Hexadecimal digits of a hash that a positive long holds.
_DIGITS = 15
#: Slices of 32,768 places whose bits, 4 KB a slice, are broadcast at most.
_SLICES = 1 << 14


def with_row_hash(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add the content hash in binary form, half the size of its hex text."""
    if HASH in df.columns:
        return df
    return df.withColumn(HASH, F.unhex(row_hash(df.columns, strict)))


def _present(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def deduplicate(
    df: DataFrame, keys: Sequence[str], strict: bool = False, counted: bool = False
) -> DataFrame:
    """Keep the row with the smallest content hash per key; NULL keys are one group.

    ``counted`` adds the number of rows each kept row stands for and whether they
    differ, so that the repeated keys come from the same aggregate. Without any of the
    key columns the frame passes through. Of the input, only the named helper columns
    are dropped.
    """
    keys = _present(df, keys)
    columns = [c for c in df.columns if c not in HELPERS]
    count = [F.col(COPIES), F.col(CONFLICT)] if counted else []
    if not keys:
        alone = {COPIES: F.lit(1).cast("long"), CONFLICT: F.lit(False)}
        return df.withColumns(alone).select(*columns, *count)
    hashed = with_row_hash(df, strict)
    rest = [c for c in columns if c not in keys]
    # Equal hashes fall back to the row content, so the choice is deterministic.
    smallest = F.min(F.struct(HASH, *content_columns(rest), *_lineage(rest)))
    largest = [F.max(HASH).alias("__largest")] if counted else []
    kept = hashed.groupBy(*keys).agg(
        smallest.alias("__kept"), F.count(F.lit(1)).alias(COPIES), *largest
    )
    if counted:
        differ = F.col(f"__kept.{HASH}") != F.col("__largest")
        kept = kept.withColumn(CONFLICT, differ)
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"__kept.{c}").alias(c) for c in columns],
        *count,
    )


def placed(df: DataFrame, label: str, strict: bool = False) -> DataFrame:
    """The rows staged with the start of their content hash and a unique place each.

    The start is 60 bits as a number, a quarter of the hash, which does not compress.
    """
    hashed = with_row_hash(df, strict)
    start = F.conv(F.substring(F.hex(HASH), 1, _DIGITS), 16, 10).cast("long")
    rows = hashed.withColumn(CONTENT, start).drop(HASH)
    return stage(rows.withColumn(PLACE, F.monotonically_increasing_id()), label)


def choose_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the place of the kept row, the number of copies, and whether they differ.

    ``rows`` is a frame of ``placed`` rows. Every buffer of the aggregate has a fixed
    width, so it is a hash aggregate: rows are neither sorted nor moved whole. Hashes are
    compared by their first 60 bits. Rows of equal content that differ in lineage are told
    apart by a hash of it, so reruns over the same rows keep the same one.
    """
    keys = _present(rows, keys)
    order = content = F.col(CONTENT)
    lineage = [c for c in rows.columns if c in LINEAGE_COLUMNS]
    if lineage:
        low = F.xxhash64(*lineage).bitwiseAND(F.lit((1 << 60) - 1))
        high = content.cast("decimal(19,0)") * F.lit(1 << 60).cast("decimal(19,0)")
        order = (high + low.cast("decimal(19,0)")).cast("decimal(38,0)")
    numbers = rows.select(
        *keys, PLACE, content.alias("__content"), order.alias("__order")
    )
    return numbers.groupBy(*keys).agg(
        F.min_by(PLACE, "__order").alias(PLACE),
        F.count(F.lit(1)).alias(COPIES),
        (F.min("__content") != F.max("__content")).alias(CONFLICT),
    )


def chosen_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows at the chosen places, without the helper columns.

    Counts the slices of places first. Up to ``_SLICES`` of them (64 MB, half a billion
    rows) are broadcast as bits; beyond that rows and places meet in a shuffle.
    """
    columns = [c for c in rows.columns if c not in HELPERS]
    places = chosen.select(PLACE)
    number, position = F.bitmap_bucket_number(PLACE), F.bitmap_bit_position(PLACE)
    if places.select(number).distinct().count() > _SLICES:
        return rows.join(places, PLACE, "left_semi").select(*columns)
    slices = places.groupBy(number.alias("__slice")).agg(
        F.bitmap_construct_agg(position).alias("__bits")
    )
    byte = F.substring("__bits", F.shiftright(position, 3).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), position % 8)
    same = number == F.col("__slice")
    return rows.join(F.broadcast(slices), same).filter(bit == 1).select(*columns)


def _lineage(columns: Sequence[str]) -> list[str]:
    content = set(content_columns(columns))
    return [c for c in columns if c not in content]


def duplicate_keys(
    df: DataFrame, keys: Sequence[str], strict: bool = False
) -> DataFrame:
    """Keys held by more than one row: number of rows, and whether they differ.

    Only key and hash are shuffled, after one reduction per map task.
    """
    keys = _present(df, keys)
    return (
        with_row_hash(df, strict)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias(COPIES),
            (F.min(HASH) != F.max(HASH)).alias(CONFLICT),
        )
        .filter(F.col(COPIES) > 1)
    )


def duplicate_issues(
    df: DataFrame, keys: Sequence[str], dataset: Dataset, strict: bool = False
) -> DataFrame | None:
    """One issue per repeated key: a warning for exact copies, else an error."""
    keys = _present(df, keys)
    if not keys:
        return None
    return repeated_issues(duplicate_keys(df, keys, strict), keys, dataset)


def repeated_issues(
    counted: DataFrame, keys: Sequence[str], dataset: Dataset
) -> DataFrame | None:
    """The same from rows that carry their number of copies and the conflict flag."""
    keys = _present(counted, keys)
    if not keys:
        return None
    copies = F.col(COPIES).cast("string")
    found = counted.filter(F.col(COPIES) > 1).select(
        record_key(keys).alias("record_key"),
        F.when(F.col(CONFLICT), "error").otherwise("warning").alias("severity"),
        F.when(F.col(CONFLICT), "conflicting_duplicate_key")
        .otherwise("exact_duplicate_key")
        .alias("rule_name"),
        F.concat(
            copies, F.lit(" rows share this business key.")
        ).alias("issue_message"),
        copies.alias("raw_value"),
    )
    return found.select(*dataset.issue_columns(found))
