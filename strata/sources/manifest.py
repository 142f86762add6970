"""Which raw files arrived, and whether every required one did."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Outcomes of a fetch.
SUCCESS, FAILED = "success", "failed"


@dataclass(frozen=True)
class ExpectedFile:
    source: str
    source_group: str
    file_name: str
    description: str = ""
    source_url: str = ""
    required: bool = True

    @property
    def relative_path(self) -> str:
        """Where the file belongs: in the folder of its group, if it has one."""
        return f"{self.source_group}/{self.file_name}".lstrip("/")


_EXPECTED_DDL = (
    "source string, source_group string, file_name string, description string, "
    "source_url string, required boolean, relative_path string"
)


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Name, path, size and time of all files with content; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("raw_file_path"),
        F.col("length").alias("bytes_written"),
        F.col("modificationTime").alias("modified_at"),
    )


def scanned_files(df: DataFrame) -> DataFrame:
    """Rows and size of each file that a scan reads, from the metadata of its rows."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("raw_file_path"),
            F.col("_metadata.file_size").alias("bytes_written"),
        )
        .groupBy("raw_file_path")
        .agg(
            F.count(F.lit(1)).alias("n_rows"), F.max("bytes_written").alias("bytes_written")
        )
    )


def _expected(spark: SparkSession, expected: Sequence[ExpectedFile]) -> DataFrame:
    rows = [(*astuple(e), e.relative_path) for e in expected]
    return spark.createDataFrame(rows, _EXPECTED_DDL)


def manifest(
    spark: SparkSession,
    expected: Sequence[ExpectedFile],
    path: str,
    fetched_at: dt.datetime | None = None,
) -> DataFrame:
    """One row per expected file; a missing or empty file counts as failed.

    A file is known by its path under ``path``, so files of one name in the folders of
    different groups do not stand for each other.
    """
    wanted = _expected(spark, expected)
    under = path.rstrip("/").split(":", 1)[-1] + "/"
    start = F.locate(under, F.col("raw_file_path")) + len(under)
    found = (
        list_files(spark, path)
        .withColumn("relative_path", F.col("raw_file_path").substr(start, F.lit(1 << 20)))
        .drop("file_name")
    )
    return wanted.join(found, "relative_path", "left").select(
        *_DESCRIPTION,
        "raw_file_path",
        "required",
        *_outcome(F.col("raw_file_path").isNotNull()),
        F.coalesce("bytes_written", F.lit(0)).alias("bytes_written"),
        (F.current_timestamp() if fetched_at is None else F.lit(fetched_at)).alias(
            "fetched_at_utc"
        ),
    )


_DESCRIPTION = ("source", "source_group", "description", "source_url", "file_name")


def _outcome(arrived: Column) -> list[Column]:
    return [
        F.when(arrived, SUCCESS).otherwise(FAILED).alias("download_status"),
        F.when(~arrived, "File is missing or empty").alias("error_message"),
    ]


def scanned_manifest(
    spark: SparkSession, expected: Sequence[ExpectedFile], rows: DataFrame
) -> DataFrame:
    """The same against ``(file_name, n_rows)`` of scanned files, by relative path."""
    found = rows.withColumnRenamed("file_name", "relative_path")
    return _expected(spark, expected).join(found, "relative_path", "left").select(
        *_DESCRIPTION, "required", "n_rows", *_outcome(F.col("n_rows").isNotNull())
    )


def archive_members(
    spark: SparkSession, path: str, source: str, source_url: str, version: str
) -> DataFrame:
    """One row per text file unpacked from an archive, tagged with its version."""
    return list_files(spark, path, "*.txt").select(
        F.lit(source).alias("source"),
        F.lit(source_url).alias("source_url"),
        F.lit(version).alias("database_version"),
        F.col("file_name").alias("saved_file_name"),
        F.col("raw_file_path").alias("saved_file_path"),
        "bytes_written",
    )


def archive_summary(members: DataFrame) -> DataFrame:
    """File count and size per archive."""
    return members.groupBy("source", "source_url", "database_version").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("bytes_written").alias("bytes_written"),
    )


def missing_required(manifest_rows: DataFrame) -> DataFrame:
    """Required files that did not arrive."""
    return manifest_rows.filter(
        F.col("required") & (F.col("download_status") == FAILED)
    ).select("source", "source_group", "file_name", "error_message")


def require_sources(manifest_rows: DataFrame) -> None:
    """Raise when a required file is missing; optional ones may be. Runs a job."""
    failed = missing_required(manifest_rows).orderBy("file_name").collect()
    if failed:
        listing = ", ".join(f"{r.file_name} ({r.error_message})" for r in failed)
        raise RuntimeError(f"Required source files are missing: {listing}")
