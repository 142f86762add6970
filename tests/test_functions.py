from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from strata.functions import amounts, codes, headers, keys, periods


@pytest.fixture()
def evaluate(spark):
    """Apply a column function to literal values."""

    def run(function, values, type_name="string"):
        df = spark.createDataFrame(
            list(enumerate(values)), f"i int, v {type_name}"
        ).select("i", function(F.col("v")).alias("out"))
        return [r.out for r in df.orderBy("i").collect()]

    return run


def test_base_code(evaluate):
    values = [
        "151252", "15-1252", "15-1252.00", " 15-1252.01\t", "15-12", "", None,
        "15 12 52", "abc151252x9", "15-1252.001",
    ]
    assert evaluate(codes.base_code, values) == [
        "15-1252", "15-1252", "15-1252", "15-1252", None, None, None,
        "15-1252", "15-1252", "15-1252",
    ]


def test_detailed_code(evaluate):
    values = ["15-1252.01", " 15-1252.01\n", "15-1252", "15-1252.1", "x15-1252.01", None]
    assert evaluate(codes.detailed_code, values) == [
        "15-1252.01", "15-1252.01", None, None, None, None,
    ]


def test_yes_no(evaluate):
    values = ["Y", " yes ", "TRUE", "t", "1", "N", "no\t", "False", "F", "0", "maybe", "",
              None]
    assert evaluate(codes.yes_no, values) == [True] * 5 + [False] * 5 + [None] * 3


def test_labels(evaluate):
    assert evaluate(codes.preparation_label, [1, 5, 6, None], "int") == [
        "little_or_no_preparation", "extensive_preparation", "unknown", "unknown",
    ]
    assert evaluate(codes.scale_label, ["im", "LV", "Xy", None]) == [
        "importance", "level", "xy", None,
    ]
    assert evaluate(codes.major_group_code, ["15-1252"]) == ["15-0000"]


@pytest.mark.parametrize(
    "raw, bound, number",
    [
        (">=$239,200", "greater_than_or_equal", 239200.0),
        ("≥ 239200", "greater_than_or_equal", 239200.0),
        ("<= 10", "less_than_or_equal", 10.0),
        ("≤10", "less_than_or_equal", 10.0),
        ("> 1 000", "greater_than", 1000.0),
        ("<5.5", "less_than", 5.5),
        (" 49,500 ", "exact", 49500.0),
        ("about 5", "exact", None),
        (None, None, None),
    ],
)
def test_amounts(evaluate, raw, bound, number):
    assert evaluate(amounts.amount_qualifier, [raw]) == [bound]
    cast = evaluate(
        lambda c: amounts.safe_cast(amounts.amount_text(c), "double"), [raw]
    )
    assert cast == [number]


def test_safe_cast(evaluate):
    def to_int(c):
        return amounts.safe_cast(c, "int")

    assert evaluate(to_int, ["1,200", "$5", "7%", "12.7", "1e3", "$", "x", None]) == [
        1200, 5, 7, None, None, None, None, None,
    ]
    assert evaluate(lambda c: amounts.safe_cast(c, "date"), ["2024-02-30", "2024-02-29"]) == [
        None, dt.date(2024, 2, 29),
    ]
    assert evaluate(lambda c: amounts.safe_cast(c, "decimal(5,2)"), ["1,234.5", "1e9"]) == [
        None, None,
    ]


def test_counts_and_direction(evaluate):
    values = [300.5, 0.0004, -10.0, None, float("nan"), 1e300]
    assert evaluate(amounts.thousands_to_count, values, "double") == [
        300500, 0, -10000, None, None, None,
    ]
    assert evaluate(amounts.direction, [0.1, -0.1, 0.0, None], "double") == [
        "growing", "declining", "no_change", "unknown",
    ]


def test_source_month(evaluate):
    assert evaluate(periods.source_month, ["08/2023", "13/2023", "2023-08", None]) == [
        dt.date(2023, 8, 1), None, None, None,
    ]


@pytest.mark.parametrize(
    "period, kind, day",
    [
        ("A01", "annual", dt.date(2023, 1, 1)),
        ("M13", "annual", dt.date(2023, 1, 1)),
        ("M03", "monthly", dt.date(2023, 3, 1)),
        ("M12", "monthly", dt.date(2023, 12, 1)),
        ("S01", "semiannual", dt.date(2023, 1, 1)),
        ("S02", "semiannual", dt.date(2023, 7, 1)),
        ("M00", "other", None),
        ("Q01", "other", None),
        (None, "other", None),
    ],
)
def test_periods(evaluate, period, kind, day):
    assert evaluate(periods.period_type, [period]) == [kind]
    assert evaluate(
        lambda c: periods.observation_date(F.lit(2023), c), [period]
    ) == [day]
    assert evaluate(
        lambda c: periods.observation_date(F.lit(123456), c), [period]
    ) == [None]


def test_record_key(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    row = df.select(
        keys.record_key(["x", "y", "z"]).alias("k"), keys.record_key([]).alias("none")
    ).first()
    assert (row.k, row.none) == ("a|<null>|3", None)


def test_row_hash_ignores_lineage_and_column_order(spark):
    df = spark.createDataFrame(
        [("b", None, 1, "run", "path")],
        "y string, z string, x int, run_id string, source_file_path string",
    )
    expected = hashlib.sha256(b"1||b||<null>").hexdigest()
    assert df.select(keys.row_hash(df.columns)).first()[0] == expected
    other = df.select("run_id", "x", "z", "y", "source_file_path")
    assert other.select(keys.row_hash(other.columns)).first()[0] == expected


def test_strict_row_hash_separates_what_the_default_joins(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    plain = df.select(keys.row_hash(df.columns).alias("h")).distinct().count()
    strict = df.select(keys.row_hash(df.columns, strict=True).alias("h")).distinct().count()
    assert (plain, strict) == (1, 2)


@pytest.mark.parametrize(
    "raw, name",
    [
        ("O*NET-SOC Code", "onet_soc_code"),
        ("Data Value", "data_value"),
        ("Employment, 2024", "employment_2024"),
        (" Employment change, percent, 2024–34 ", "employment_change_percent_2024_34"),
        ("Median annual wage, dollars, 2024[1]", "median_annual_wage_dollars_2024_1"),
        ("__a--b(c)/d%", "a_b_c_d"),
        ("Größe", "gr_e"),
    ],
)
def test_snake_case(raw, name):
    assert headers.snake_case(raw) == name


def test_header_clash_is_an_error():
    with pytest.raises(ValueError, match=r"\['a_b'\]"):
        headers.snake_case_all(["A B", "a-b", "c"])


def test_blank_and_repeated_headers():
    assert headers.fill_header(["a", "", None, "a"]) == [
        "a", "Unnamed: 1", "Unnamed: 2", "a.1",
    ]
