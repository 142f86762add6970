"""A clean table as a declaration: source layout, casts, checks, key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.functions.keys import HELPERS
from strata.operators.clean import Field, base_frame, select_fields
from strata.operators.dedup import choose_rows, chosen_rows, placed, repeated_issues
from strata.operators.quality import (
    MALFORMED,
    Dataset,
    InRange,
    Matches,
    WellFormed,
    check,
    issue_rows,
    union_issues,
    valid_rows,
)
from strata.sources.files import read_delimited, read_with_header_offset
from strata.sources.tables import stage


@dataclass(frozen=True)
class TableSpec:
    """One clean table.

    ``fields=None`` keeps all source columns. ``header_row=None`` means that the
    header is the first line; a number skips the preamble above it.
    """

    name: str
    source_system: str
    file_name: str
    required: Sequence[str]
    key: Sequence[str]
    fields: Sequence[Field] | None = None
    casts: Mapping[str, str] = field(default_factory=dict)
    cast_key: Sequence[str] | None = None
    rules: Sequence[Matches | InRange] = ()
    header_row: int | None = None

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        if self.header_row is None:
            return read_delimited(spark, path, malformed=MALFORMED)
        return read_with_header_offset(spark, path, self.header_row)

    def dataset(
        self, path: str, run_id: str, run_time: dt.datetime | None = None
    ) -> Dataset:
        return Dataset(run_id, self.source_system, self.name, path, run_time)

    def annotate(
        self,
        spark: SparkSession,
        path: str,
        run_id: str,
        run_time: dt.datetime | None = None,
    ) -> tuple[DataFrame, DataFrame | None]:
        """Cleaned, cast and checked rows, and issues for absent columns."""
        base = base_frame(self.read(spark, path), path, run_id, run_time)
        selected = base
        if self.fields is not None:
            selected = select_fields(base, [*self.fields, Field(MALFORMED)])
        annotated, missing = check(
            selected,
            self.dataset(path, run_id, run_time),
            self.required,
            self.key,
            self.casts,
            self.cast_key,
            (*self.rules, WellFormed(tuple(self.key))),
        )
        return annotated.drop(MALFORMED), missing

    def build(
        self,
        spark: SparkSession,
        path: str,
        run_id: str,
        run_time: dt.datetime | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        """Clean rows and issue rows of one source."""
        annotated, missing = self.annotate(spark, path, run_id, run_time)
        dataset = self.dataset(path, run_id, run_time)
        finished = Finished.of(annotated, missing, self.required, self.key, dataset)
        return finished.clean(), finished.issues()


@dataclass(frozen=True)
class Finished:
    """A checked table, staged once; its clean rows and issues are reads of the stage.

    Staging evaluates the cleaning and the checks exactly once. The clean rows, the
    findings and the repeated keys then read only the columns they need. The choice of
    the kept rows is staged too, as numbers: it tells the repeated keys, and whole rows
    move only where they are written.
    """

    staged: DataFrame
    missing: DataFrame | None
    required: Sequence[str]
    key: Sequence[str]
    dataset: Dataset

    @classmethod
    def of(
        cls,
        annotated: DataFrame,
        missing: DataFrame | None,
        required: Sequence[str],
        key: Sequence[str],
        dataset: Dataset,
    ) -> Finished:
        """Write the annotated frame, with hash and place of each row, to the stage."""
        return cls(placed(annotated, dataset.name), missing, required, key, dataset)

    @property
    def valid(self) -> DataFrame:
        return valid_rows(self.staged, self.required)

    @cached_property
    def chosen(self) -> DataFrame | None:
        """One row per key with its number of copies; None without any key column."""
        if not any(k in self.staged.columns for k in self.key):
            return None
        return stage(choose_rows(self.valid, self.key), self.dataset.name)

    def clean(self) -> DataFrame:
        """Rows with every required value, one per key."""
        if self.chosen is None:
            return self.valid.drop(*HELPERS)
        return chosen_rows(self.valid, self.chosen)

    def issues(self) -> DataFrame:
        """All issues: absent columns, findings of the rows, repeated keys."""
        repeated = None
        if self.chosen is not None:
            repeated = repeated_issues(self.chosen, self.key, self.dataset)
        return union_issues(
            self.staged.sparkSession,
            [self.missing, issue_rows(self.staged, self.dataset), repeated],
        )
