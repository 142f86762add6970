from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives
from strata.llm.hard_negatives import Codebooks, Settings, fit, mine, scores

SCHEMA = "vec_id long, label int, embedding array<float>"
COLUMNS = (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
)


def brute(rows, every=5):
    """The contract over all pairs, in Python's whole numbers."""
    width = max((len(v) for _, _, v in rows if v is not None), default=0)
    kept = []
    for id, label, vector in rows:
        if label is None or vector is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        kept.append((id, label, whole + [0] * (width - len(whole))))
    found = []

    def order(x):
        return (-x[0], x[1] is None, x[1] or 0)

    for i, (id, label, vector) in enumerate(kept):
        if id is None or id % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, other)), oid, olabel == label)
            for j, (oid, olabel, other) in enumerate(kept)
            if j != i
        ]
        for score, pid, _ in sorted((x for x in scored if x[2]), key=order)[:5]:
            inside = [
                x for x in scored if not x[2] and 50 * score <= 100 * x[0] <= 95 * score
            ]
            for rank, x in enumerate(sorted(inside, key=order)[:3], 1):
                found.append((id, pid, rank, x[1], score, x[0]))
    return sorted(found, key=repr)


def made(n=160, seed=4):
    rnd = random.Random(seed)
    centers = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(n):
        center = rnd.choice(centers)
        vector = [c + rnd.gauss(0, 0.4) for c in center]
        rows.append((i, rnd.randrange(3), vector))
    # Copies of an anchor's vector, repeated rows and ids, and rows that take no part.
    rows += [(1000 + i, 1, [0.5] * 6) for i in range(30)]
    rows += [(2000 + i, 2, [0.5, 0.5, 0.5, 0.5, 0.5, 0.4]) for i in range(12)]
    rows += [rows[5], rows[5], (10, 0, rows[11][2]), (None, 1, rows[12][2])]
    rows += [(5, None, [1.0] * 6), (15, 1, None), (20, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(25, 1, [float("nan")] * 6), (30, 1, [float("inf")] * 6)]
    rows += [(35, 1, [0.25, 1.0]), (40, 0, []), (45, 0, [0.0] * 6), (50, 9, [1.0] * 6)]
    return rows


SMALL = Settings(cell_rows=8, first_cells=2, block_rows=16, fit_rounds=3)


@pytest.mark.parametrize("how", [Settings(), SMALL])
def test_equal_to_all_pairs(spark, rows, how):
    data = made()
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = rows(mine(frame, F.col("vec_id") % 5 == 0, how=how), *COLUMNS)
    assert sorted(got, key=repr) == brute(data)


def test_searches_end_before_all_cells_where_vectors_form_groups(spark, rows, monkeypatch):
    rnd = random.Random(2)
    data = []
    for i in range(300):
        group = i % 6
        vector = [0.0] * 12
        vector[2 * group] = 3.0 + rnd.random()
        vector[2 * group + 1] = rnd.random()
        data.append((i, i % 2, vector))
    visited = []
    plain = hard_negatives._visits

    def counted(queries, books, done, step):
        found = plain(queries, books, done, step)
        visited.append((found.count(), queries.count() * int((books.sizes > 0).sum())))
        return found

    monkeypatch.setattr(hard_negatives, "_visits", counted)
    how = Settings(cell_rows=6, first_cells=2, fit_rounds=4)
    frame = spark.createDataFrame(data, SCHEMA)
    got = rows(mine(frame, F.col("vec_id") % 5 == 0, how=how), *COLUMNS)
    assert sorted(got, key=repr) == brute(data)
    assert sum(n for n, _ in visited) < max(every for _, every in visited)


def test_bounds_are_never_below_a_score():
    rnd = np.random.default_rng(1)
    vectors = rnd.integers(-300, 300, (400, 10))
    books = fit(vectors, 6, 4)
    halves = books.halves(vectors)
    near = [hard_negatives._nearest(h, c) for h, c in zip(halves, books.centroids)]
    radii = tuple(
        np.array([np.linalg.norm(h[n == i] - c[i], axis=1).max(initial=0) for i in range(len(c))])
        for h, c, n in zip(halves, books.centroids, near)
    )
    sizes = np.bincount(near[0] * 6 + near[1], minlength=36)
    books = Codebooks(books.centroids, radii, sizes)
    queries = rnd.integers(-300, 300, (20, 10))
    first, second = books.bounds(queries)
    exact = scores(vectors, queries)
    for q in range(20):
        walked = list(books.walk(first[q], second[q]))
        assert sorted(c for c, _ in walked) == np.flatnonzero(sizes).tolist()
        assert [b for _, b in walked] == sorted((b for _, b in walked), reverse=True)
        bound = dict(walked)
        for v in range(400):
            assert exact[v, q] <= bound[near[0][v] * 6 + near[1][v]]


def test_scores_stay_exact_beyond_the_floats():
    a = np.array([[(1 << 28) - 1] * 40, [1] * 40], dtype=np.int64)
    b = np.array([[(1 << 28) - 3] * 40], dtype=np.int64)
    want = [[sum(int(x) * int(y) for x, y in zip(r, b[0]))] for r in a]
    assert scores(a, b).tolist() == want


def test_large_components(spark, rows):
    most = float(2**19)
    data = [(0, 0, [most] * 4), (1, 0, [most - 1] * 4), (2, 1, [most * 0.75] * 4)]
    data += [(3, 1, [float(2**20)] * 4), (4, 0, [1e30] * 4)]
    frame = spark.createDataFrame(data, SCHEMA)
    got = rows(mine(frame, F.col("vec_id") == 0), *COLUMNS)
    assert got == [r for r in brute(data[:3], every=10)] and len(got) == 1


def test_empty_table_and_lone_rows(spark):
    anchor = F.col("vec_id") % 5 == 0
    for data in ([], [(0, 1, [1.0])], [(0, None, [1.0])], [(0, 1, [1.0]), (1, 2, [1.0])]):
        assert mine(spark.createDataFrame(data, SCHEMA), anchor).collect() == []


def test_clashing_columns_and_other_names(spark, rows):
    data = made(60)
    frame = spark.createDataFrame(
        [(*r, "k", 7, [1]) for r in data],
        "id long, kind int, v array<float>, key string, cell int, windows array<int>",
    )
    got = rows(mine(frame, F.col("id") % 5 == 0, "id", "v", "kind"), *COLUMNS)
    assert sorted(got, key=repr) == brute(data)
