from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import minhash
from strata.llm.buffers import utf8
from strata.llm.components import roots

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([" ".join(w)] if w else [])
    return frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """doc_id -> (size, component) by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def texts(seed=3, n=60):
    """Bases, copies with edits on both sides of the limit, and a group with a rim."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(n // 6):
        words = rnd.choices(vocabulary, k=rnd.randrange(30, 120))
        rows.append(list(words))
        for _ in range(5):
            copy = list(words)
            for _ in range(rnd.randrange(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(copy)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(rows)]


def test_components_match_brute_force(spark):
    rows = texts(n=180)
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one TWO"), (1004, "One two")]
    rows += [(1005, "one two\x0bthree four five"), (1006, "one two three four five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {
        r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in minhash.near_duplicates(docs).collect()
    }
    assert got == brute(rows)


def test_a_group_with_many_unlinked_members_keeps_every_link(spark):
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(60)]
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(0, 9)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(words)))
    want = brute(rows)
    assert len({c for _, c in want.values()}) > 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in minhash.near_duplicates(docs).collect()}
    assert got == want


def test_extra_columns_repeats_and_missing_ids(spark):
    rows = [(5, "a b c d e f", "x", 1), (5, "a b c d e f", "y", 2), (2, "A B C D E F", "z", 3)]
    rows += [(None, "a b c d e f", "n", 4), (9, None, "e", 5)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, component_id string, kept int"
    )
    got = sorted(minhash.near_duplicates(docs).collect(), key=str)
    assert sorted(
        ((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=str
    ) == sorted([(5, 2, False), (5, 2, False), (2, 2, True), (None, 2, False), (9, 9, True)], key=str)
    left = minhash.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 9]


def test_rows_without_id_or_with_a_repeated_id_stay_by_their_text(spark):
    words = [f"u{i}" for i in range(60)]
    near = [*words[:30], "other", *words[31:]]
    rows = [(None, " ".join(words)), (None, " ".join(words)), (None, " ".join(near))]
    rows += [(None, "a text of its own here"), (None, ""), (None, None), (None, "")]
    rows += [(7, "first of two texts with one id"), (7, "second text that has the same id")]
    rows += [(7, "second text that has the same id"), (8, " ".join(f"p{i}" for i in range(60)))]
    rows += [(None, " ".join(f"p{i}" for i in range(59)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in minhash.drop_duplicates(docs).collect()]
    assert sum(i is None and (t or "").startswith("u0") for i, t in left) == 1
    want = [(None, "a text of its own here"), (None, ""), (None, None), (None, ""), rows[7], rows[8], rows[10]]
    assert sorted((r for r in left if not (r[1] or "").startswith("u0")), key=str) == sorted(want, key=str)
    got = [tuple(r) for r in minhash.near_duplicates(docs).collect()]
    # The near copy without id is linked to the row that names the component.
    assert len(got) == len(rows) and (None, 55, 8, False) in got and (8, 56, 8, True) in got


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert minhash.near_duplicates(docs).collect() == []
    assert minhash.drop_duplicates(docs).collect() == []


def test_long_text_has_the_shingles_of_its_words():
    text = " ".join(f"t{i % 3001}" for i in range(300_000))
    sets = minhash.shingle_sets(*utf8(pa.array([text, "", None])))
    assert [len(s) for s in sets] == [3001, 0, 0]


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.95])
def test_odd_sketches_estimate_similarity(similarity):
    random_ = np.random.default_rng(1)
    total = 4000
    both = int(total * similarity)
    pool = random_.integers(0, 1 << 63, total, dtype=np.uint64)
    sets = [np.sort(pool[: both + (total - both) // 2]), np.sort(np.concatenate([pool[:both], pool[both + (total - both) // 2 :]]))]
    how = minhash.Settings()
    sketches = minhash.odd_sketches(
        minhash._signatures(sets, how.fine_samples, 3), how.fine_words
    )
    bits, k = 64 * how.fine_words, how.fine_samples
    z = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
    estimate = 1 + bits / (4 * k) * np.log(1 - 2 * z / bits)
    assert abs(estimate - similarity) < 0.06


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(7, 7), (60, 59), (59, 60), (None, 3)]
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in roots(frame).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)} | {60: 59}
    assert got == want
