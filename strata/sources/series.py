"""Time-series documents: flatten nested JSON, take the newest observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout and success status of a series response.
RESPONSE_SCHEMA = """
    status STRING,
    Results STRUCT<series: ARRAY<STRUCT<
        seriesID: STRING,
        data: ARRAY<STRUCT<
            year: STRING, period: STRING, periodName: STRING, value: STRING,
            footnotes: ARRAY<STRUCT<code: STRING, text: STRING>>>>>>>
"""
SUCCEEDED = "REQUEST_SUCCEEDED"


def flatten_responses(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per observation of the responses that succeeded."""
    response = F.from_json(F.col(column), RESPONSE_SCHEMA).alias("response")
    return (
        documents.select(response)
        .filter(F.col("response.status") == SUCCEEDED)
        .select(F.explode("response.Results.series").alias("series"))
        .select(
            F.col("series.seriesID").alias("series_id"),
            F.explode("series.data").alias("point"),
        )
        .select(
            "series_id",
            "point.year",
            "point.period",
            F.col("point.periodName").alias("period_name"),
            "point.value",
            F.array_join("point.footnotes.code", ",").alias("footnote_codes"),
        )
    )


def latest(
    df: DataFrame, series: Sequence[str], newest_by: Sequence[str | Column]
) -> DataFrame:
    """The newest row of each series, by an aggregate that reduces before the shuffle."""
    rest = [c for c in df.columns if c not in series]
    order = [
        F.col(c).alias(f"__by_{i}") if isinstance(c, str) else c.alias(f"__by_{i}")
        for i, c in enumerate(newest_by)
    ]
    newest = F.max(F.struct(*order, *rest)).alias("__newest")
    return (
        df.groupBy(*series)
        .agg(newest)
        .select(*series, *[F.col(f"__newest.{c}").alias(c) for c in rest])
    )
