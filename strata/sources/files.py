"""Text-file scans. Every column is read as a string; casting is a later step."""

from __future__ import annotations

import csv
import io
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.headers import fill_header
from strata.operators.clean import drop_empty_rows
from strata.sources.tables import stage


def read_delimited(
    spark: SparkSession, path: str, delimiter: str = "\t", malformed: str | None = None
) -> DataFrame:
    """Delimited file with a header line; ragged rows are padded or cut.

    With ``malformed`` a column of that name holds the text of rows that have more or
    fewer cells than the header, and NULL for all others.
    """
    options = {
        "sep": delimiter,
        "header": True,
        "encoding": "UTF-8",
        "mode": "PERMISSIVE",
        "inferSchema": False,
    }
    plain = spark.read.options(**options).csv(path)
    if malformed is None:
        return plain
    # A scan that skips columns does not see how many a row has.
    options |= {"columnNameOfCorruptRecord": malformed, "columnPruning": False}
    schema = T.StructType([*plain.schema.fields, T.StructField(malformed, T.StringType())])
    return spark.read.schema(schema).options(**options).csv(path)


def read_with_header_offset(
    spark: SparkSession,
    path: str,
    header_row: int,
    delimiter: str = "\t",
    line_breaks: bool = True,
) -> DataFrame:
    """Delimited file whose header is row ``header_row``, counted from zero.

    The rows before it are a preamble and are skipped; a blank line is a row. A folder may
    hold several files; each is read by its own header, so their columns may be in any
    order, but they must be the same columns. Blank cells become NULL; rows and columns
    without any value are dropped. The rows are parsed once, into a stage that tells which
    columns hold values.

    A quoted cell may hold line breaks, quotes in it are doubled. As only the whole file
    tells which breaks are inside a cell, a file is then read by one task. Files that are
    known to have none are split over tasks with ``line_breaks=False``.
    """
    if line_breaks:
        numbered = stage(_records(spark, path, delimiter), "records")
        headers = _headers(numbered, header_row, _blank_rows(spark, path, header_row, delimiter))
    else:
        numbered = _numbered(spark.read.text(path))
        headers = _headers(numbered, header_row)
    headers = stage(headers, "headers")
    # One row for each spelling of the header, however many files there are.
    spellings = (
        headers.groupBy("__header").agg(F.min("__file").alias("file")).orderBy("file")
    ).collect()
    if not spellings:
        raise ValueError(f"{path} has no line {header_row + 1} to take a header from")
    names = {
        r["__header"]: fill_header(
            next(csv.reader(io.StringIO(r["__header"], newline=""), delimiter=delimiter))
        )
        for r in spellings
    }
    first = names[spellings[0]["__header"]]
    for r in spellings:
        if sorted(names[r["__header"]]) != sorted(first):
            raise ValueError(
                f"{r['file']} has the columns {names[r['__header']]}, "
                f"but {spellings[0]['file']} has {first}"
            )
    rows = numbered.join(headers, "__file").filter(
        ~F.col("__opening") | (F.col("__id") - F.col("__first") > F.col("__at"))
    )
    options = {"sep": delimiter, "escape": '"'}
    parsed = [
        rows.filter(F.col("__header") == header)
        .select(F.from_csv("value", _ddl(own), options).alias("row"))
        .select(*[F.col("row").getField(n).alias(n) for n in first])
        for header, own in names.items()
    ]
    kept = drop_empty_rows(reduce(DataFrame.unionAll, parsed))
    return drop_empty_columns(stage(kept, "parsed"), path)


#: Lines at the head of a file in which its header row has to begin.
_HEAD_LINES = 1000


def _records(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """The texts of the records of the files, line breaks inside cells included.

    Read as one column, every record with another number of cells is malformed, and the
    scan hands out the text of malformed records. What is well-formed is a single cell.
    """
    options = {
        "sep": delimiter,
        "header": False,
        "multiLine": True,
        "escape": '"',
        "encoding": "UTF-8",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "__text",
    }
    scan = spark.read.schema("__cell string, __text string").options(**options).csv(path)
    quoted = F.concat(F.lit('"'), F.replace("__cell", F.lit('"'), F.lit('""')), F.lit('"'))
    return scan.select(
        F.coalesce("__text", quoted).alias("value"),
        F.monotonically_increasing_id().alias("__id"),
        F.col("_metadata.file_path").alias("__file"),
        F.lit(True).alias("__opening"),
    )


def _blank_rows(
    spark: SparkSession, path: str, header_row: int, delimiter: str
) -> DataFrame:
    """For each file the blank lines among its first ``header_row`` rows.

    A scan of records leaves them out. The first lines of a file are folded in order, and
    a line inside a quoted cell is no row.
    """
    sep = re.escape(delimiter)
    whole = rf'(^|{sep})"[^"]*+(?:""[^"]*+)*+"(?={sep}|$)'
    begun, closed = rf'(^|{sep})"', rf'^[^"]*+(?:""[^"]*+)*+"(?={sep}|$)'

    def opens(text: Column) -> Column:
        return F.regexp_replace(text, whole, "$1").rlike(begun)

    def step(state: Column, line: Column) -> Column:
        text = line["value"]
        inside, row = state["inside"], ~state["inside"] & (state["rows"] < header_row)
        rest = F.regexp_replace(text, closed, "")
        goes_on = F.when(inside, ~text.rlike(closed) | opens(rest)).otherwise(opens(text))
        # Below the header nothing is counted, so its cells need not be followed.
        return F.struct(
            (state["rows"] + row.cast("int")).alias("rows"),
            (state["blank"] + (row & (text == "")).cast("int")).alias("blank"),
            (goes_on & (state["rows"] < header_row)).alias("inside"),
        )

    lines = _numbered(spark.read.text(path)).filter("__opening")
    first = lines.groupBy("__file").agg(F.min("__id").alias("__first"))
    head = (
        lines.join(first, "__file")
        .filter(F.col("__id") - F.col("__first") < _HEAD_LINES)
        .groupBy("__file")
        .agg(F.sort_array(F.collect_list(F.struct("__id", "value"))).alias("lines"))
    )
    start = F.struct(
        F.lit(0).alias("rows"), F.lit(0).alias("blank"), F.lit(False).alias("inside")
    )
    return head.select("__file", F.aggregate("lines", start, step)["blank"].alias("__blank"))


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their file and an id that grows by one per line within a task.

    The block that opens a file is read first to last by one task, so a line of that
    block is known by its distance from the block's first id.
    """
    return lines.select(
        "value",
        F.monotonically_increasing_id().alias("__id"),
        F.col("_metadata.file_path").alias("__file"),
        (F.col("_metadata.file_block_start") == 0).alias("__opening"),
    )


def _headers(
    numbered: DataFrame, header_row: int, blank: DataFrame | None = None
) -> DataFrame:
    """For each file its header, the id of its first row, and the header's distance."""
    opening = numbered.filter("__opening")
    first = opening.groupBy("__file").agg(F.min("__id").alias("__first"))
    if blank is None:
        first = first.withColumn("__at", F.lit(header_row))
    else:
        first = first.join(blank, "__file").select(
            "__file", "__first", (header_row - F.col("__blank")).alias("__at")
        )
    return (
        opening.join(first, "__file")
        .filter(F.col("__id") - F.col("__first") == F.col("__at"))
        .select("__file", "__first", "__at", F.col("value").alias("__header"))
    )


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)


def drop_empty_columns(df: DataFrame, path: str = "the source") -> DataFrame:
    """Drop columns without a value; runs one aggregate over the frame."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    filled = df.agg(*[F.count(F.col(q)) for q in quoted]).first()
    kept = [F.col(q) for q, values in zip(quoted, filled) if values]
    if not kept:
        raise ValueError(f"{path} holds no value in any column")
    return df.select(*kept)
