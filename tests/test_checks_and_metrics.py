from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import checks
from strata.operators.lookups import left_lookup, unique_lookup
from strata.operators.metrics import MetricView


def test_repeated_keys(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k int, t string")
    assert rows(checks.repeated_keys(df, ["k", "t"])) == [(1, "a", 2), (2, None, 2)]
    assert checks.repeated_keys(df.dropDuplicates(), ["k"]).count() == 0


def test_null_and_hit_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert checks.null_counts(df, {"na": "a", "nb": "b"}).first() == (1, 2)
    assert checks.lookup_hits(df, {"a": "a", "b": "b"}, "n").first() == (3, 2, 1)
    empty = df.limit(0)
    assert checks.null_counts(empty, {"na": "a"}).first() == (None,)
    assert checks.lookup_hits(empty, {"a": "a"}).first() == (0, None)


def test_match_counts_equal_a_left_join(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    lookup = spark.createDataFrame([(1,), (2,), (2,), (None,)], "c int")
    joined = fact.join(lookup, F.col("k") == F.col("c"), "left")
    expected = joined.agg(
        F.count("*"), F.count("c"), F.count(F.when(F.col("c").isNull(), 1))
    ).first()
    assert tuple(checks.match_counts(fact, lookup, "k", "c").first()) == tuple(expected)
    assert tuple(expected) == (6, 4, 2)
    missed = checks.unmatched_rows(fact, lookup, "k", "c")
    assert sorted(map(repr, (r.k for r in missed.collect()))) == ["3", "None"]
    none = checks.match_counts(fact.limit(0), lookup, "k", "c").first()
    assert tuple(none) == (0, None, None)


def test_coverage(spark, rows):
    dimension = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, t int")
    members = spark.createDataFrame(
        [("a", "m1"), ("a", "m1"), ("a", "m2"), ("a", None), (None, "m3"), ("z", "m4")],
        "code string, m string",
    )
    covered = checks.coverage(
        dimension,
        "k",
        {"many": (members, "code", "m"), "none": (members.limit(0), "code", "m")},
    )
    assert rows(covered) == [("a", 1, 2, 0), ("b", 2, 0, 0), (None, 3, 0, 0)]


def test_lookup_does_not_fan_out(spark, rows):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    names = spark.createDataFrame([("a", "x"), ("a", "y")], "code string, name string")
    lookup = unique_lookup(names, "code", {"name": "name", "n": F.count(F.lit(1))})
    joined = left_lookup(fact, lookup, {"k": "code"}, {"title": "name", "n": "n"})
    assert rows(joined) == [("a", 1, "y", 2), ("b", 2, None, None), (None, 3, None, None)]


@pytest.fixture()
def view(spark):
    df = spark.createDataFrame(
        [
            ("a", "x", "keep", 10, 1.0),
            ("a", "y", "keep", 20, None),
            ("b", "x", "keep", 5, 3.0),
            ("c", None, "keep", None, 4.0),
            ("d", "x", "drop", 1000, 1000.0),
        ],
        "title string, kind string, scope string, openings int, wage double",
    )
    return MetricView(
        source=df,
        filter="scope = 'keep'",
        measures={"openings": "sum(openings)", "wage": F.avg("wage")},
        dimensions={"title": "title", "kind": "kind", "pay": "wage", "double": "2 * wage"},
    )


def test_totals_ignore_nulls_and_filtered_rows(view):
    total = view.query(["openings", "wage"]).first()
    assert (total.openings, round(total.wage, 6)) == (35, round(8 / 3, 6))


def test_grouped_and_filtered_measures(view, rows):
    assert rows(view.query(["openings"], ["title"])) == [("a", 30), ("b", 5), ("c", None)]
    assert rows(view.query(["openings"], ["title"], {"kind": ["x", None]})) == [
        ("a", 10), ("b", 5), ("c", None),
    ]
    known = view.rows(["title", "double"], where=lambda d: d["kind"].isNotNull())
    assert rows(known) == [("a", 2.0), ("a", None), ("b", 6.0)]


def test_rankings(view):
    best = view.top_rows("pay", ["pay", "title"], 3)
    assert [(r.pay, r.title) for r in best.collect()] == [(4.0, "c"), (3.0, "b"), (1.0, "a")]
    groups = view.top_groups("openings", ["title"], 5)
    assert [tuple(r) for r in groups.collect()] == [("a", 30), ("b", 5), ("c", None)]


def test_facets_count_rows_that_pass_the_other_facets(view, rows):
    counts = view.facet_counts(["title", "kind"], {"title": ["a"], "kind": ["x"]})
    assert rows(counts) == sorted(
        [
            ("title", "a", 1), ("title", "b", 1), ("title", "c", 0),
            ("kind", "x", 1), ("kind", "y", 1), ("kind", None, 0),
        ],
        key=repr,
    )
    everything = view.facet_counts(["title"])
    assert rows(everything) == [("title", "a", 2), ("title", "b", 1), ("title", "c", 1)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
