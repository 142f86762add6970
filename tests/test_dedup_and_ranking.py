from __future__ import annotations

import hashlib
import random
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.keys import row_hash
from strata.operators import dedup
from strata.operators.dedup import (
    choose_rows,
    chosen_rows,
    deduplicate,
    duplicate_issues,
    duplicate_keys,
    placed,
    repeated_issues,
)
from strata.operators.quality import Dataset
from strata.operators.ranking import (
    dense_rank,
    dense_rank_by_window,
    placed_values,
    top,
)
from strata.sources.tables import stage

DATASET = Dataset("run", "SYS", "t", "t.txt")
DDL = "k1 string, k2 int, v string"


def text(value) -> str:
    return "<null>" if value is None else str(value)


def smallest_hash(group):
    return min(
        group, key=lambda r: hashlib.sha256("||".join(map(text, r)).encode()).hexdigest()
    )


def brute_force(data):
    ordered = sorted(data, key=lambda r: repr(r[:2]))
    groups = [list(g) for _, g in groupby(ordered, key=lambda r: r[:2])]
    kept = sorted((smallest_hash(g) for g in groups), key=repr)
    repeated = sorted(
        ((*g[0][:2], len(g), len(set(g)) > 1) for g in groups if len(g) > 1), key=repr
    )
    return kept, repeated


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.sampled_from([1, 2, None]),
        st.sampled_from(["x", "y", "||", None]),
    ),
    max_size=30,
)
FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(ROWS)
def test_dedup_against_brute_force(spark, rows, data):
    df = spark.createDataFrame(data, DDL)
    kept, repeated = brute_force(data)
    assert rows(deduplicate(df, ["k1", "k2", "absent"])) == kept
    assert rows(duplicate_keys(df, ["k1", "k2"])) == repeated


@FEW
@given(ROWS)
def test_chosen_places_against_brute_force(spark, rows, data):
    staged = placed(spark.createDataFrame(data, DDL), "places")
    kept, repeated = brute_force(data)
    chosen = choose_rows(staged, ["k1", "k2", "absent"])
    assert rows(chosen_rows(staged, chosen)) == kept
    more = chosen.filter("__copies > 1").select("k1", "k2", "__copies", "__conflict")
    assert rows(more) == repeated


def test_places_are_chosen_without_sorting_rows(spark, rows):
    df = spark.range(4000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise("hot").alias("k"),
        (F.col("id") % 7).cast("string").alias("v"),
        F.concat(F.lit("file"), F.col("id") % 3).alias("source_file_path"),
    )
    staged = placed(df, "places").repartition(5)
    chosen = choose_rows(staged, ["k"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan and "Window" not in plan
    kept = chosen_rows(staged, chosen)
    assert kept.columns == df.columns and kept.count() == 401
    # Equal content in three files: the same row is kept however the rows are dealt.
    again = chosen_rows(staged.repartition(3), choose_rows(staged.repartition(3), ["k"]))
    assert rows(again) == rows(kept)
    hashes = df.filter("k = 'hot'").select(row_hash(df.columns).alias("h"), "v")
    least = hashes.orderBy("h").first()["v"]
    assert kept.filter("k = 'hot'").first()["v"] == least


def test_chosen_rows_are_not_moved_and_carry_no_whole_hash(spark, rows, monkeypatch):
    df = spark.range(100_000, numPartitions=3).select(
        (F.col("id") % 70_001).alias("k"), F.concat(F.lit("v"), "id").alias("v")
    )
    staged = placed(df, "places")
    assert "__row_hash" not in staged.columns
    assert staged.schema["__row_hash_start"].dataType.simpleString() == "bigint"
    chosen = stage(choose_rows(staged, ["k"]), "chosen")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        kept = chosen_rows(staged, chosen)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
        monkeypatch.setattr(dedup, "_SLICES", 0)
        shuffled = chosen_rows(staged, chosen)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 70_001
        assert rows(kept) == rows(shuffled) == rows(deduplicate(df, ["k"]))
    finally:
        spark.conf.set(limit, before)


def test_a_key_holding_most_rows_is_reduced_before_the_shuffle(spark):
    df = spark.range(20000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), "id"
    )
    kept = deduplicate(df, ["k"], counted=True)
    assert kept.count() == 2001
    assert kept.filter("k = -1").first()["__copies"] == 18000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1
    assert "Window" not in plan and plan.count("Exchange") == 1


def test_without_key_columns_rows_pass_through(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x")], DDL)
    assert deduplicate(df, ["absent"]).count() == 2
    assert duplicate_issues(df, ["absent"], DATASET) is None


def test_equal_content_keeps_the_smallest_lineage(spark):
    df = spark.createDataFrame(
        [("a", "file2"), ("a", "file1")], "k string, source_file_path string"
    )
    assert deduplicate(df, ["k"]).first().source_file_path == "file1"


def test_duplicate_issues(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "x"), (None, 2, "x"), (None, 2, "y"), ("c", 3, "z")], DDL
    )
    found = duplicate_issues(df, ["k1", "k2"], DATASET).select(
        "record_key", "severity", "rule_name", "issue_message", "raw_value"
    )
    message = "2 rows share this business key."
    assert rows(found) == [
        ("<null>|2", "error", "conflicting_duplicate_key", message, "2"),
        ("a|1", "warning", "exact_duplicate_key", message, "2"),
    ]


def ranked_input(spark):
    rng = random.Random(7)
    data = [
        (
            rng.choice(["hot"] * 6 + ["cold", None]),
            rng.choice([1.0, 2.0, 2.5, None]),
            rng.choice(["n%d" % i for i in range(9)] + [None]),
            i,
        )
        for i in range(400)
    ]
    return spark.createDataFrame(data, "g string, v double, n string, i int")


ORDER = [("v", "desc"), ("n", "asc")]


def test_ranks_by_ranges_equal_ranks_by_window(spark, rows):
    df = ranked_input(spark)
    for order in (ORDER, [("n", "asc"), ("v", "desc")], [("v", "asc")], [("i", "desc")]):
        for groups in (["g"], []):
            expected = rows(dense_rank_by_window(df, groups, order))
            assert rows(dense_rank(df, groups, order)) == expected


def test_ranks_of_odd_numbers(spark, rows):
    values = [0.0, -0.0, -1e300, 1e300, float("inf"), float("-inf"), float("nan"), None]
    values += [x / 7 for x in range(-40, 40)] + [1e-9, -1e-9]
    df = spark.createDataFrame([("g", v, i) for i, v in enumerate(values)], "g string, v double, i int")
    for way in ("asc", "desc"):
        expected = rows(dense_rank_by_window(df, ["g"], [("v", way)]), "i", "rank")
        assert rows(dense_rank(df, ["g"], [("v", way)]), "i", "rank") == expected
    assert dense_rank(df.limit(0), ["g"], [("v", "asc")]).collect() == []


@pytest.mark.parametrize(
    "value",
    [
        "concat('https://one.example/path/', lpad(cast(id as string), 9, '0'))",
        "timestamp_seconds(1704067200 + id)",
        "id + 9000000000000000000",
        "named_struct('same', 1, 'id', id)",
    ],
)
def test_a_hot_group_is_spread_whatever_its_values_are(spark, rows, value):
    df = spark.range(20_000).selectExpr(
        "if(id % 20 = 0, 'cold', 'hot') AS g", f"{value} AS v", "id"
    )
    placed = placed_values(df, ["g"], [("v", "desc")])
    sizes = sorted(r["count"] for r in placed.groupBy("__range").count().collect())
    assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[1]
    spread = placed.filter("g = 'hot'").select("__range").distinct().count()
    assert spread >= 3
    ranked = dense_rank(df, ["g"], [("v", "desc")])
    assert rows(ranked, "id", "rank") == rows(
        dense_rank_by_window(df, ["g"], [("v", "desc")]), "id", "rank"
    )


def test_windows_hold_a_row_for_each_range(spark):
    ranked = dense_rank(ranked_input(spark), ["g"], ORDER)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "__range" in windows[0]


def test_columns_named_like_helpers_are_data(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, __v string")
    kept = deduplicate(df, ["k"], counted=True)
    assert kept.columns == ["k", "__v", "__copies", "__conflict"]
    assert [(r["k"], r["__copies"], r["__conflict"]) for r in kept.orderBy("k").collect()] == [
        (1, 2, True),
        (2, 1, False),
    ]
    hashes = df.select(row_hash(df.columns).alias("h")).distinct()
    assert hashes.count() == 3


def test_clean_rows_and_repeated_keys_come_from_one_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], DDL)
    counted = deduplicate(df, ["k1", "k2"], counted=True)
    found = repeated_issues(counted, ["k1", "k2"], DATASET)
    for frame in (counted, found):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_top_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("b", 2), ("a", 2), ("c", None), ("d", 1)], "name string, v int"
    )
    assert [r.name for r in top(df, [("v", "desc"), ("name", "asc")], 4).collect()] == [
        "a", "b", "d", "c",
    ]
    plan = top(df, [("v", "desc")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
