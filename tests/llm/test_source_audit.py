from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import source_audit
from strata.llm.source_audit import Settings, divergences, share

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=10):
    """Rows of ``(text, lang, source)`` by the definitions, in Python's whole numbers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = []
    for lang in {lang for _, lang, _ in rows}:
        words, docs = {}, Counter()
        for text, of, source in rows:
            if of == lang:
                mine = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(LOW))
                words.setdefault(source, Counter()).update(mine)
                docs.update(set(mine))
        kept = [t for t, n in docs.items() if n >= least]

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {
                t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept
            }

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        whole = shares(sum(words.values(), Counter()))
        own = {s: shares(c) for s, c in words.items()}
        for s in own:
            pairs = [
                (sum(gap(own[s][t], own[o][t]) for t in kept), o) for o in own if o != s
            ]
            terms = [
                (gap(own[s][t], whole[t]), t)
                for t in kept
                if words[s][t] and own[s][t] > whole[t]
            ]
            for part, values, limit in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:limit]
                found += [
                    (lang, s, part, item, value, i + 1)
                    for i, (value, item) in enumerate(ordered)
                ]
    return sorted(found)


def made(n=150):
    rnd = random.Random(5)
    words = [f"w{'abcdefghij'[i % 10]}{'xyz'[i // 10]}" for i in range(30)]
    words += ["Été", "ÉTÉ", "zürich", "Don't", "a1b2", "語彙", "\U0001f600x"]
    rows = []
    for i in range(n):
        text = rnd.choice([" ", "\n", "-", "\x00"]).join(
            rnd.choices(words[: rnd.randrange(3, len(words) + 1)], k=rnd.randrange(0, 40))
        )
        rows.append((text, rnd.choice(["en", "en", "en", "fr", None, ""]), f"s{i % 4}"))
    rows += [(None, "en", "silent"), ("", "xx", None), ("only here once", "xx", "b")]
    rows += [rows[3]] * 20 + [("WAX " * 50, "en", None)]
    return rows


SCHEMA = "text string, lang string, source string"


@pytest.mark.parametrize(
    "how",
    [
        Settings(),
        Settings(least_documents=2, entries=40, cells=16),
        Settings(least_documents=1, entries=7, cells=1, top_terms=3),
    ],
)
def test_equal_to_plain_counts(spark, rows, how):
    docs = spark.createDataFrame(made(), SCHEMA).repartition(5)
    got = rows(divergences(docs, how=how), "lang", "source", "part", "item", "value", "rank")
    assert sorted(got) == brute(made(), how.least_documents, how.top_terms)


def test_columns_of_other_names_and_clashes(spark, rows):
    data = [(*r, 1, "x", 2) for r in made(40)]
    docs = spark.createDataFrame(
        data, "body string, language string, origin string, term long, lang string, total int"
    )
    got = divergences(docs, "body", "language", "origin", Settings(least_documents=2))
    names = ("lang", "source", "part", "item", "value", "rank")
    assert sorted(rows(got, *names)) == brute(made(40), 2)


def test_empty_table_and_lone_source(spark):
    assert divergences(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([("a b", "en", "s")] * 3, SCHEMA)
    assert divergences(alone).collect() == []


def test_a_very_long_text_is_read_whole(spark, rows):
    long = " ".join(f"{'abcdefg'[i % 7]}b" for i in range(900_000)) + "c" * 3_000_000
    data = [(long, "en", "s"), ("ab ab bb", "en", "t"), ("ab zz", "en", "t")]
    got = divergences(spark.createDataFrame(data, SCHEMA), how=Settings(least_documents=1))
    names = ("lang", "source", "part", "item", "value", "rank")
    assert sorted(rows(got, *names)) == brute(data, 1)


def test_shares_are_exact_where_products_leave_the_long_range():
    count = np.array([0, 1, 9_300_000_000, 8_999_999_999_999_998], dtype=np.int64)
    total = np.int64(8_999_999_999_999_999)
    want = [1 + 10**9 * int(c) // int(total) for c in count]
    assert share(count, total).tolist() == want


def test_terms_of_pieces_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK", 8)
    data = b"one two three fourfivesixseven  eight nine" * 3
    assert [t for p in source_audit.terms(data) for t in p] == re.findall(rb"[a-z]+", data)
