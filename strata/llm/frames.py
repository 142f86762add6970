"""Small helpers shared by the operators: table reads, unused names, shared folders."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import new_folder

#: Words are runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def _importable(spark: SparkSession) -> None:
    """Let local Python workers import this package from where it lies.

    On a cluster it is installed or shipped like any other package.
    """
    root, held = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = [p for p in held.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        held["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    _importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later reads prune columns, and an executor that is lost costs no recomputation of
    what came before. The folder is not deleted here: the returned frame reads it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keys(df: DataFrame, label: str, most: int = 1 << 20) -> DataFrame:
    """Staged key rows for a join: broadcast up to ``most`` rows, shuffled beyond.

    Whole rows are then joined to few keys where they are, and not moved at all.
    """
    held = staged(df, label)
    return F.broadcast(held) if held.count() <= most else held
