"""Labelled rows for the classifiers: a bounded sample to learn from, and who is held out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id: Column, modulus: int) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % modulus


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    rows: int,
    max_bytes: int,
) -> pd.DataFrame:
    """At most ``rows`` labelled texts of at most ``max_bytes``, with label 0 or 1.

    ``docs`` has doc_id and text; ``learn`` is a condition on doc_id. Of the labels that
    have such a text the rows are those with the smallest hash of their id, so labels of
    other tables take none of the places and every run learns from the same rows. Only
    their texts are moved: the ids are at most ``rows``, which bounds the broadcast. Of a
    document labelled more than once the larger label counts, of rows that repeat an
    id the text that sorts first.
    """
    texts = F.coalesce("text", F.lit(""))
    short = docs.filter(F.octet_length(texts) <= max_bytes)
    known = (
        labels.filter(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .join(short.filter(learn).select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    chosen = (
        short.join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(texts).alias("text"))
        .orderBy("doc_id")
    )
    return chosen.toPandas()
