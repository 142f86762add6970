"""Row checks that write issue rows beside the data.

All checks of a table are evaluated in one projection: each row carries an array
of its findings, which is NULL for a clean row. Clean rows and issue rows are two
reads of that one annotated frame, so the number of checks adds no scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.amounts import safe_cast
from strata.functions.keys import ISSUES, record_key
from strata.operators.clean import keep_required


# The layout of the issue table.
ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source_system", T.StringType(), False),
        T.StructField("dataset_name", T.StringType(), False),
        T.StructField("source_file_path", T.StringType(), False),
        T.StructField("record_key", T.StringType(), True),
        T.StructField("severity", T.StringType(), False),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("issue_message", T.StringType(), False),
        T.StructField("raw_value", T.StringType(), True),
        T.StructField("detected_at", T.TimestampType(), False),
    ]
)
FINDING_COLUMNS = ("record_key", "severity", "rule_name", "issue_message", "raw_value")


@dataclass(frozen=True)
class Dataset:
    """Who reports an issue: the constant columns of the issue rows."""

    run_id: str
    source_system: str
    name: str
    source_path: str
    detected_at: dt.datetime | None = None

    def issue_columns(self, source: DataFrame) -> list[Column]:
        clock = (
            F.current_timestamp()
            if self.detected_at is None
            else F.lit(self.detected_at)
        )
        constants = {
            "run_id": F.lit(self.run_id),
            "source_system": F.lit(self.source_system),
            "dataset_name": F.lit(self.name),
            "source_file_path": F.lit(self.source_path),
            "detected_at": clock,
        }
        return [
            constants[n].alias(n) if n in constants else source[n]
            for n in ISSUE_SCHEMA.names
        ]


@dataclass(frozen=True)
class Matches:
    """Non-null values must match the pattern."""

    column: str
    pattern: str
    key: tuple[str, ...]
    severity: str = "error"

    def finding(self, values: Mapping[str, Column]) -> Finding | None:
        if self.column not in values:
            return None
        value = values[self.column]
        return Finding(
            value.isNotNull() & ~value.rlike(self.pattern),
            _key(self.key, values),
            self.severity,
            "invalid_format",
            f"The value of {self.column!r} is not of the form {self.pattern!r}.",
            value.cast("string"),
        )


@dataclass(frozen=True)
class InRange:
    """Non-null values must lie between two bounds, both included.

    The record key is the bare key column, without a stand-in for NULL.
    """

    column: str
    low: int
    high: int
    key: str
    rule: str
    message: str
    severity: str = "error"

    def finding(self, values: Mapping[str, Column]) -> Finding | None:
        if self.column not in values:
            return None
        value = values[self.column]
        return Finding(
            value.isNotNull() & ~value.between(self.low, self.high),
            values[self.key].cast("string"),
            self.severity,
            self.rule,
            self.message,
            value.cast("string"),
        )


@dataclass(frozen=True)
class Required:
    """The value must not be NULL; the reported raw value is the column name."""

    column: str
    key: tuple[str, ...]

    def finding(self, values: Mapping[str, Column]) -> Finding | None:
        if self.column not in values:
            return None
        return Finding(
            values[self.column].isNull(),
            _key(self.key, values),
            "error",
            "missing_required_value",
            f"{self.column!r} must have a value.",
            F.lit(self.column),
        )


#: Column that carries the text of rows whose cells do not match the header.
MALFORMED = "malformed_source_row"


@dataclass(frozen=True)
class WellFormed:
    """The row has as many cells as the header; reported with its text, and kept."""

    key: tuple[str, ...]
    column: str = MALFORMED

    def finding(self, values: Mapping[str, Column]) -> Finding | None:
        if self.column not in values:
            return None
        return Finding(
            values[self.column].isNotNull(),
            _key(self.key, values),
            "warning",
            "malformed_row",
            "The row has more or fewer cells than the header.",
            values[self.column],
        )


@dataclass(frozen=True)
class Finding:
    """One check compiled to columns: when it fails and what it then reports."""

    failed: Column
    key: Column
    severity: str
    rule: str
    message: str
    raw_value: Column

    def entry(self, failed: Column) -> Column:
        return F.when(
            failed,
            F.struct(
                self.key.alias("record_key"),
                F.lit(self.severity).alias("severity"),
                F.lit(self.rule).alias("rule_name"),
                F.lit(self.message).alias("issue_message"),
                self.raw_value.alias("raw_value"),
            ),
        )


def _key(columns: Sequence[str], values: Mapping[str, Column]) -> Column:
    return record_key([values[c] for c in columns if c in values])


def annotate(
    df: DataFrame,
    casts: Mapping[str, str] | None = None,
    cast_key: Sequence[str] = (),
    rules: Sequence[Matches | InRange | Required] = (),
) -> DataFrame:
    """Cast columns, run the checks, and attach the findings as ``__issues``.

    Casts run in order, and the record key of a failed cast reads the columns
    cast so far, so a key column that failed itself reads ``<null>``. Rules see
    the cast values.
    """
    casts = {c: t for c, t in (casts or {}).items() if c in df.columns}
    values = {c: F.col(c) for c in df.columns}
    findings: list[Finding] = []
    typed = df.select(
        "*", *[safe_cast(F.col(c), t).alias(f"__cast_{c}") for c, t in casts.items()]
    )
    for column, type_name in casts.items():
        raw, values[column] = values[column], F.col(f"__cast_{column}")
        findings.append(
            Finding(
                raw.isNotNull() & values[column].isNull(),
                _key(cast_key, values),
                "error",
                "invalid_type_cast",
                f"The value of {column!r} is no {type_name!r}.",
                raw.cast("string"),
            )
        )
    findings += [f for f in (rule.finding(values) for rule in rules) if f]
    if not findings:
        none = F.lit(None).cast(_ISSUE_ARRAY)
        return typed.select(*[values[c] for c in df.columns], none.alias(ISSUES))
    # First whether each check failed, then the findings of the rows where one did.
    flags = [f"__failed_{i}" for i in range(len(findings))]
    flagged = typed.select(
        "*", *[f.failed.alias(flag) for f, flag in zip(findings, flags)]
    )
    any_failed = reduce(or_, [F.col(flag) for flag in flags])
    entries = F.array(*[f.entry(F.col(flag)) for f, flag in zip(findings, flags)])
    return flagged.select(
        *[values[c].alias(c) for c in df.columns],
        F.when(any_failed, entries).alias(ISSUES),
    )


_ISSUE_ARRAY = T.ArrayType(
    T.StructType([T.StructField(c, T.StringType()) for c in FINDING_COLUMNS])
)


def valid_rows(annotated: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with every required value; other findings are reported, not dropped."""
    return keep_required(annotated.drop(ISSUES), required)


def findings(annotated: DataFrame) -> DataFrame:
    """One row per finding.

    Clean rows are left out by exploding an empty array, not by a filter: a filter
    would be pushed below the projection and evaluate every check a second time.
    """
    none = F.array().cast(_ISSUE_ARRAY)
    return (
        annotated.select(F.explode(F.coalesce(ISSUES, none)).alias("finding"))
        .filter(F.col("finding").isNotNull())
        .select("finding.*")
    )


def issue_rows(annotated: DataFrame, dataset: Dataset) -> DataFrame:
    """The findings of an annotated frame in the layout of the issue table."""
    rows = findings(annotated)
    return rows.select(*dataset.issue_columns(rows))


def missing_column_rows(
    spark: SparkSession, columns: Iterable[str], required: Sequence[str], dataset: Dataset
) -> DataFrame | None:
    """One issue per required column that the source lacks; known from the schema."""
    present = set(columns)
    missing = [
        (None, "error", "missing_required_column",
         f"The source has no column {c!r}.", c)
        for c in required
        if c not in present
    ]
    if not missing:
        return None
    rows = spark.createDataFrame(missing, _ISSUE_ARRAY.elementType)
    return rows.select(*dataset.issue_columns(rows))


def empty_issues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ISSUE_SCHEMA)


def union_issues(
    spark: SparkSession, frames: Iterable[DataFrame | None]
) -> DataFrame:
    """Union by name in the issue layout; ``None`` is skipped."""
    parts = [f.select(*ISSUE_SCHEMA.names) for f in frames if f is not None]
    if not parts:
        return empty_issues(spark)
    return reduce(DataFrame.unionByName, parts)


def check(
    df: DataFrame,
    dataset: Dataset,
    required: Sequence[str],
    key: Sequence[str],
    casts: Mapping[str, str] | None = None,
    cast_key: Sequence[str] | None = None,
    rules: Sequence[Matches | InRange] = (),
) -> tuple[DataFrame, DataFrame | None]:
    """Annotate a frame with casts, rules and required checks.

    Returns the annotated frame and the issue rows for columns that are missing
    altogether (``None`` when there are none).
    """
    required_rules = [Required(c, tuple(key)) for c in required]
    annotated = annotate(
        df, casts, key if cast_key is None else cast_key, [*rules, *required_rules]
    )
    missing = missing_column_rows(df.sparkSession, df.columns, required, dataset)
    return annotated, missing
