from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import clean, quality
from strata.operators.quality import Dataset, InRange, Matches, Required, annotate

DATASET = Dataset("run", "SYS", "numbers", "numbers.txt")


def test_trim_keeps_inner_and_other_whitespace(spark, rows):
    df = spark.createDataFrame([("  a b ", 1), ("\tx", 2), (None, 3)], "s string, n int")
    assert rows(clean.trim_strings(df)) == [("\tx", 2), ("a b", 1), (None, 3)]


def test_placeholders(spark):
    values = ["", " ", "—", "–", "-", "N/A", "n/A", "NA", "Null", "none", "0", "--", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    kept = [r.s for r in clean.nullify_placeholders(df).collect()]
    assert kept == [None] * 9 + ["none", "0", "--", None]


def test_placeholder_tokens_are_a_parameter(spark):
    df = spark.createDataFrame([("missing value",), ("-",)], "s string")
    kept = [r.s for r in clean.nullify_placeholders(df, ["Missing Value"]).collect()]
    assert kept == [None, "-"]


def test_lineage_can_name_the_file_of_each_row(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    df = clean.with_lineage(spark.read.parquet(path), None, "r")
    assert all("part-" in r.source_file_path for r in df.collect())


def test_mapping_takes_the_first_candidate_and_skips_absent_optionals(spark):
    df = clean.with_lineage(
        spark.createDataFrame([("1", "2")], "b string, c string"), "p", "r"
    )
    mapped = clean.select_mapped(df, {"x": ("a", "b", "c")}, {"y": ("q",), "z": ("c",)})
    assert mapped.columns == ["x", "z", "source_file_path", "run_id", "processed_at"]
    with pytest.raises(ValueError, match="'w'.*available"):
        clean.select_mapped(df, {"w": ("q",)})


def test_codes_of_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("15-1252.01",)], "code string")
    assert clean.add_codes(df, "nope", "neither").columns == ["code"]
    assert clean.add_codes(df, "code").first()[1:] == ("15-1252.01", "15-1252")
    with pytest.raises(ValueError, match="onet_soc_code"):
        clean.split_detailed_code(df)


def test_required_rows_keep_nan_and_ignore_absent_columns(spark):
    df = spark.createDataFrame(
        [("a", float("nan")), (None, 1.0), ("b", None)], "k string, v double"
    )
    assert [r.k for r in clean.keep_required(df, ["k", "v", "absent"]).collect()] == ["a"]
    assert clean.keep_required(df, ["absent"]).count() == 3


def annotated_numbers(spark):
    df = spark.createDataFrame(
        [("1", "5", "ab"), ("x", "7", "ab"), ("2", "y", "zz"), (None, "9", None)],
        "id string, size string, tag string",
    )
    return annotate(
        df,
        {"id": "int", "size": "int", "absent": "int"},
        ("id", "size"),
        [
            Matches("tag", "^a", ("id",), "warning"),
            Matches("absent", "^a", ("id",)),
            InRange("size", 1, 8, "id", "bad_size", "Size is off."),
            Required("id", ("id", "size")),
            Required("tag", ("id",)),
        ],
    )


def test_findings_of_all_checks(spark, rows):
    found = rows(quality.findings(annotated_numbers(spark)))
    assert found == sorted(
        [
            # The failed key itself reads <null>; a column cast later is still text.
            ("<null>|7", "error", "invalid_type_cast", "The value of 'id' is no 'int'.", "x"),
            ("2|<null>", "error", "invalid_type_cast", "The value of 'size' is no 'int'.",
             "y"),
            ("2", "warning", "invalid_format",
             "The value of 'tag' is not of the form '^a'.", "zz"),
            (None, "error", "bad_size", "Size is off.", "9"),
            ("<null>|7", "error", "missing_required_value",
             "'id' must have a value.", "id"),
            ("<null>|9", "error", "missing_required_value",
             "'id' must have a value.", "id"),
            ("<null>", "error", "missing_required_value",
             "'tag' must have a value.", "tag"),
        ],
        key=repr,
    )


def test_only_rows_without_required_values_are_dropped(spark, rows):
    valid = quality.valid_rows(annotated_numbers(spark), ["id"])
    assert rows(valid) == [(1, 5, "ab"), (2, None, "zz")]


def test_checks_are_evaluated_once_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "a")], "id string, tag string").write.parquet(path)
    annotated = annotate(
        spark.read.parquet(path),
        {"id": "int"},
        ("id",),
        [Matches("tag", "^b", ("id",)), Required("tag", ("id",))],
    )
    plan = quality.findings(annotated)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("RLIKE(tag") == 1
    assert "Python" not in plan


def test_issue_layout(spark):
    issues = quality.issue_rows(annotated_numbers(spark), DATASET)
    assert issues.columns == quality.ISSUE_SCHEMA.names
    assert issues.dtypes == quality.empty_issues(spark).dtypes
    first = issues.first()
    assert (first.run_id, first.source_system, first.dataset_name) == (
        "run", "SYS", "numbers",
    )


def test_missing_columns_are_reported_from_the_schema(spark):
    missing = quality.missing_column_rows(spark, ["a"], ["a", "b"], DATASET)
    row = missing.first()
    assert (row.rule_name, row.raw_value, row.record_key) == (
        "missing_required_column", "b", None,
    )
    assert quality.missing_column_rows(spark, ["a"], ["a"], DATASET) is None


def test_union_of_issue_frames(spark):
    issues = quality.issue_rows(annotated_numbers(spark), DATASET)
    shuffled = issues.select(*reversed(issues.columns), F.lit(1).alias("extra"))
    both = quality.union_issues(spark, [issues, None, shuffled])
    assert both.columns == quality.ISSUE_SCHEMA.names
    assert both.count() == 2 * issues.count()
    assert quality.union_issues(spark, [None]).count() == 0


def test_no_checks_no_findings(spark):
    annotated = annotate(spark.range(2))
    assert quality.findings(annotated).count() == 0
    assert quality.valid_rows(annotated, ["id"]).count() == 2
