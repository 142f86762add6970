from __future__ import annotations

import random
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import byte_bpe, pretokens
from strata.llm.byte_bpe import Settings, decode, encode

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def plain() -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "plain",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.rank_table(RANKS),
        special_tokens={},
    )


def cut(texts: list[str]) -> list[str]:
    data = [t.encode() for t in texts]
    begin = pretokens.starts(b"".join(data), np.cumsum([0] + [len(d) for d in data]))
    ends = [*begin[1:].tolist(), sum(map(len, data))]
    return [b"".join(data)[a:b].decode() for a, b in zip(begin.tolist(), ends)]


ODD = list("ab sS'tmdrevl  \n\t1 2.,é語\x1c\x85\xa0　²Ⅷ\U0001f600_-") + ["'re", "'ll", " '"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=12).map("".join), max_size=5))
def test_pretokens_are_the_matches_of_the_pattern(texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert cut(texts) == [m for t in texts for m in pattern.findall(t)]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_pretokens_of_any_text(text):
    assert cut([text]) == regex.findall(public_tokenizers.PATTERN, text)


def test_long_texts_are_cut_where_no_pretoken_crosses():
    rnd = random.Random(3)
    text = "".join(rnd.choices(ODD + [" it's", "x\n\n  y", ". "], k=5000))
    data = text.encode()
    found = [
        t for a, b in pretokens.pieces(data, 64) for t in cut([data[a:b].decode()])
    ]
    assert found == regex.findall(public_tokenizers.PATTERN, text)


def made() -> list[tuple[int | None, str | None]]:
    rnd = random.Random(8)
    vocabulary = ["the", "of", "It's", "12", "naïve", "語彙", "\n\n", "#$", "'ll", "we've"]
    rows: list[tuple[int | None, str | None]] = [
        (i, rnd.choice([" ", "", "  "]).join(rnd.choices(vocabulary + ODD, k=rnd.randrange(0, 60))))
        for i in range(120)
    ]
    return rows + [(7, "the the"), (None, "no id"), (200, None), (201, ""), (202, " "), rows[5]]


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 20])
def test_equal_to_the_library_and_back(spark, block_bytes):
    docs = spark.createDataFrame(made(), "doc_id long, text string").repartition(3)
    how = Settings(RANKS, block_bytes)
    got = decode(encode(docs, how), how).collect()
    want = [(i, plain().encode_ordinary(t or ""), (t or "").encode()) for i, t in made()]
    assert sorted(map(repr, ((r["doc_id"], r["ids"], bytes(r["bytes"])) for r in got))) == sorted(
        map(repr, want)
    )


def test_very_long_texts(spark):
    rnd = random.Random(9)
    texts = [
        " ".join(rnd.choices(["some", "words", "and,", "it's\n", "1234"], k=400_000)),
        "x" * 60_000 + " " * 60_000,
        "é" * 700_000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    how = Settings(RANKS)
    got = {r["doc_id"]: r for r in decode(encode(docs, how), how).collect()}
    for i, text in enumerate(texts):
        assert got[i]["ids"] == plain().encode_ordinary(text)
        assert bytes(got[i]["bytes"]).decode() == text


def test_other_columns_and_names(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x", 3, [1])], "key int, body string, text string, block long, ids array<int>"
    )
    got = encode(docs, Settings(RANKS), "key", "body").collect()
    assert [tuple(r) for r in got] == [(1, plain().encode_ordinary("a b"))]


def test_empty_table_and_odd_ids(spark):
    how = Settings(RANKS)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(none, how), how).collect() == []
    rows = [(1, None, "x"), (2, [], "y"), (3, [-1, 10**6, None, 64], "z")]
    given_ids = spark.createDataFrame(rows, "doc_id long, ids array<int>, bytes string")
    got = {r["doc_id"]: bytes(r["bytes"]) for r in decode(given_ids, how).collect()}
    assert got == {1: b"", 2: b"", 3: plain().decode_bytes([64])}


def test_each_word_is_sent_once_a_block(spark):
    docs = spark.createDataFrame([(i, "again and again " * 50) for i in range(30)], "doc_id long, text string")
    staged = byte_bpe._in_blocks(docs.coalesce(1), Settings(RANKS, 8000))
    n_blocks = staged.select("block").distinct().count()
    sent = staged.filter("part is not null").collect()
    # "again", " and", " again" and the space at the end of a text.
    assert n_blocks == 3
    assert sum(len(byte_bpe.unpacked(r["lengths"])) for r in sent) == 4 * n_blocks
    assert sum(len(r["words"]) for r in sent) == len("again and again ") * n_blocks


def test_bytes_that_are_not_text():
    block = byte_bpe.Block(0)
    data = b"ok \xff\xfe" + "gut é".encode()
    row = block.add(pa.array([1, 2]), data, np.array([0, 5, len(data)])).to_pylist()[0]
    assert block.words == [b"ok", " \ufffd\ufffd".encode(), b"gut", " é".encode()]
    assert row["counts"] == [2, 2]
    assert byte_bpe.unpacked(row["positions"]).tolist() == [0, 1, 2, 3]


@pytest.mark.parametrize("most", [0, 255, 256, 1 << 24, (1 << 32) - 1])
def test_packed_numbers(most):
    numbers = np.array([0, most // 3, most], dtype=np.int64)
    assert byte_bpe.unpacked(byte_bpe.packed(numbers)).tolist() == numbers.tolist()
    assert len(byte_bpe.unpacked(byte_bpe.packed(numbers[:0]))) == 0
