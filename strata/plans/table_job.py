"""The table job: build, write and audit every declared table of a run."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import union_issues
from strata.plans.spec import Finished, TableSpec
from strata.sources.tables import (
    DEFAULT_FORMAT,
    FOLDER_FORMATS,
    Version,
    owned_stages,
    publish_together,
    replace_run,
    write_table,
    write_version,
)

# The layout of the audit table, and the names of both logs.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source_system", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("write_mode", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("completed_at", T.TimestampType(), False),
    ]
)
ISSUE_TABLE = "data_quality_issues"
AUDIT_TABLE = "processing_audit"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass
class Audit:
    """Outcome per table write, put into the audit table at the end of a run.

    Writes that wait to be published together are held until then.
    """

    run_id: str
    rows: list[tuple] = field(default_factory=list)
    waiting: list[Version] = field(default_factory=list)

    def write(
        self,
        df: DataFrame,
        source_system: str,
        table: str,
        mode: str = "overwrite",
        wait: bool = False,
        **options,
    ) -> int:
        """Write a table and record its row count, or its error before re-raising.

        With ``wait`` the new version is written but not published.
        """
        started = utc_now()

        def record(status: str, rows: int | None, error: str | None) -> None:
            self.rows.append(
                (self.run_id, source_system, table, status, rows, mode, error,
                 started, utc_now())
            )

        try:
            if wait:
                self.waiting.append(write_version(df, table, **options))
                rows = self.waiting[-1].rows
            else:
                rows = write_table(df, table, mode, **options)
        except Exception as error:
            record("failed", None, f"{type(error).__name__}: {error}")
            raise
        record("success", rows, None)
        return rows

    def withdraw(self) -> None:
        """Take back what was written and waits or was published together."""
        names = {version.name for version in self.waiting}
        for version in self.waiting:
            version.withdraw()
        self.waiting = []
        self.rows = [
            (*r[:3], "withdrawn", *r[4:]) if r[2] in names and r[3] == "success" else r
            for r in self.rows
        ]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, AUDIT_SCHEMA)

    def append(self, spark: SparkSession, table: str, **options) -> None:
        """Put the rows into the log; rows of an earlier try of the run are replaced."""
        if self.rows:
            replace_run(self.frame(spark), table, self.run_id, **options)


@dataclass(frozen=True)
class TableJob:
    """Where a run writes.

    ``schema`` qualifies the table names; ``location`` puts the data of each table
    under a folder of its own instead of the warehouse. With ``together`` the tables of
    a run are published after all of them are written: a run that fails changes none, and
    its audit has them as withdrawn. Otherwise each table is published when it is written.
    Formats that replace tables themselves cannot wait.
    """

    spark: SparkSession
    schema: str | None = None
    location: str | None = None
    format: str = DEFAULT_FORMAT
    together: bool = False

    def __post_init__(self) -> None:
        if self.together and self.format not in FOLDER_FORMATS:
            raise ValueError(f"tables of format {self.format} cannot be published together")

    def table_name(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def _options(self, name: str) -> dict:
        options = {"format": self.format}
        if self.location:
            options["path"] = f"{self.location}/{name}"
        return options

    def run(
        self,
        specs: Sequence[TableSpec],
        paths: Mapping[str, str],
        run_id: str | None = None,
    ) -> RunResult:
        """Build and write the tables, one source system after another.

        ``paths`` maps table name to source path. All tables of a system are planned
        before the first one is written, so a source that lost a column changes no
        table. A failure stops the run: the audit is written, the issues are not,
        and the cause is chained to the error. The stages of the run are deleted at its
        end, however it ends. Issues and audit hold a run once, however often it is
        repeated under its id.
        """
        with owned_stages(self.spark):
            return self._run(specs, paths, run_id)

    def _run(
        self,
        specs: Sequence[TableSpec],
        paths: Mapping[str, str],
        run_id: str | None,
    ) -> RunResult:
        run_id = run_id or str(uuid.uuid4())
        run_time = utc_now()
        audit = Audit(run_id)
        issues: list[DataFrame] = []
        try:
            for _, group in groupby(specs, lambda spec: spec.source_system):
                planned = [
                    (s, *s.annotate(self.spark, paths[s.name], run_id, run_time))
                    for s in group
                ]
                for spec, annotated, missing in planned:
                    dataset = spec.dataset(paths[spec.name], run_id, run_time)
                    finished = Finished.of(
                        annotated, missing, spec.required, spec.key, dataset
                    )
                    issues.append(self._write(finished, audit))
            publish_together(audit.waiting)
            issue_count = self._write_issues(issues, run_id)
            audit.append(self.spark, self.table_name(AUDIT_TABLE),
                         **self._options(AUDIT_TABLE))
        except Exception as error:
            audit.withdraw()
            self._append_after_failure(audit, error)
            raise RuntimeError(f"Table job failed for run_id={run_id}: {error}") from error
        return RunResult(run_id, {r[2]: r[4] for r in audit.rows}, issue_count)

    def _write(self, finished: Finished, audit: Audit) -> DataFrame:
        """Write the clean rows of one table and return its issues."""
        name = finished.dataset.name
        audit.write(
            finished.clean(),
            finished.dataset.source_system,
            self.table_name(name),
            wait=self.together,
            **self._options(name),
        )
        return finished.issues()

    def _write_issues(self, frames: list[DataFrame], run_id: str) -> int:
        return replace_run(
            union_issues(self.spark, frames),
            self.table_name(ISSUE_TABLE),
            run_id,
            **self._options(ISSUE_TABLE),
        )

    def _append_after_failure(self, audit: Audit, cause: Exception) -> None:
        try:
            audit.append(self.spark, self.table_name(AUDIT_TABLE),
                         **self._options(AUDIT_TABLE))
        except Exception as error:
            cause.add_note(f"The audit could not be written either: {error}")


@dataclass(frozen=True)
class RunResult:
    run_id: str
    row_counts: dict[str, int]
    issue_count: int


def newest_first(log: DataFrame, clock: str) -> DataFrame:
    """Audit or issue rows, newest first."""
    return log.orderBy(F.col(clock).desc())
