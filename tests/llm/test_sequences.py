from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from strata.llm import balancing, decontamination, substrings, token_files
from strata.llm.buffers import Prefix, blocks, utf8, word_hashes
from strata.llm.queries import vocabulary
from strata.llm.wavelet import WaveletMatrix, build


# Buffers


def test_words_of_a_buffer_cut_into_blocks(monkeypatch):
    from strata.llm import buffers

    texts = ["", "a  bb\nccc", None, "é " * 50, "x" * 300, " lead", "trail ", "a bb"]
    whole = word_hashes(*utf8(pa.array(texts, pa.string())))
    assert whole[3].tolist() == [0, 3, 0, 50, 1, 1, 1, 2]
    monkeypatch.setattr(buffers, "BLOCK", 7)
    for a, b in zip(whole, word_hashes(*utf8(pa.array(texts, pa.string())))):
        assert np.array_equal(a, b)
    offsets = np.array([0, 5, 5, 400, 410])
    assert list(blocks(offsets, 100)) == [(0, 2), (2, 3), (3, 4)]


def test_equal_ranges_have_equal_hashes():
    data = np.frombuffer(b"abcabcabd", np.uint8)
    h = Prefix(data).hashes(np.array([0, 3, 6, 0]), np.array([3, 6, 9, 2]))
    assert h[0] == h[1] and len({*h.tolist()}) == 3


# Repeated strings


def brute_strings(rows, k):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + k] for i in range(len(b) - k + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        drop = bytearray(len(b))
        for p in range(len(b) - k + 1):
            if count[b[p : p + k]] > 1:
                drop[p : p + k] = b"\1" * k
        runs = sum(drop[j] and (j == 0 or not drop[j - 1]) for j in range(len(b)))
        kept = bytes(c for c, d in zip(b, drop) if not d)
        out.append((i, len(b), sum(drop), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def string_rows():
    rnd = random.Random(6)

    def text(n):
        return "".join(rnd.choices("abcdefgé \n", k=n))

    shared, other = text(700), text(450)
    rows = [(i, text(rnd.randrange(1, 1500))) for i in range(20)]
    rows += [(20, text(90) + shared + text(50)), (21, shared[100:] + text(10)), (22, other)]
    rows += [(23, other), (24, other + other), (25, None), (26, ""), (27, "ab" * 900)]
    rows += [(28, shared[:399]), (29, text(133) + shared[:500]), (30, "z" * 401), (22, other)]
    return rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_removed_strings_match_brute_force(spark, partitions):
    rows = string_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = [
        (
            r["doc_id"],
            r["n_bytes"],
            sum(s["end"] - s["start"] for s in r["spans"]),
            len(r["spans"]),
            r["kept"],
        )
        for r in substrings.repeated_strings(docs).collect()
    ]
    assert sorted(got, key=str) == brute_strings(rows, 400)


def test_the_cover_has_every_difference_and_long_texts_work(spark):
    how = substrings.Settings()
    differences = {(a - b) % how.period for a in how.cover for b in how.cover}
    assert differences == set(range(how.period))
    rnd = random.Random(1)
    long = "".join(rnd.choices("abcdefgh", k=1_200_000))
    rows = [(1, long, 0), (2, "x" + long[1_048_000 : 1_049_500], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = {r["doc_id"]: r["spans"] for r in substrings.repeated_strings(docs).collect()}
    assert [tuple(s) for s in got[1]] == [(1_048_000, 1_049_500)]
    assert [tuple(s) for s in got[2]] == [(1, 1501)]
    assert substrings.repeated_strings(docs.limit(0)).collect() == []


def test_a_pack_sends_a_repeated_string_once_and_is_cut_by_bytes(spark):
    how = substrings.Settings()
    rows = pa.table({"row": [0, 1], "doc_id": [1, 2], "text": ["-" * 50_000, "ab" * 25_000]})
    pack = substrings.Pack(rows, how, 7)
    at = np.concatenate([np.arange(49_601), 50_000 + np.arange(49_601)])
    sent = pack.blocks(0, at, how.length, 8)
    # One string of dashes and two of a and b, each with the bit of a repeated one.
    assert sum(sent.column("n").to_pylist()) == 3
    assert sum(map(len, sent.column("block").to_pylist())) <= 3 * 9
    texts = string_rows() + [(40, "=" * 5_000), (41, "no repeat"), (42, "-=" * 2_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    small = substrings.Settings(pack_bytes=1_500)
    assert substrings._in_packs(docs, small).select("pack").distinct().count() > 5
    got = [
        (r["doc_id"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept"])
        for r in substrings.repeated_strings(docs, how=small).collect()
    ]
    want = [(i, n, k) for i, _, n, _, k in brute_strings(texts, 400)]
    assert sorted(got, key=str) == sorted(want, key=str)



# Tokens


def test_wavelet_matrix_answers_like_the_sequence():
    rnd = np.random.default_rng(3)
    tokens = rnd.integers(0, 300, 5_000).astype(np.uint32)
    matrix = WaveletMatrix(build(tokens, block_bits=512))
    assert np.array_equal(matrix.decode(), tokens) and len(matrix) == 5_000
    for i in (0, 1, 511, 512, 4_999):
        assert matrix[i] == tokens[i]
    for token in (0, 17, 299, 511, 70_000):
        places = np.flatnonzero(tokens == token)
        assert matrix.count(token) == len(places)
        inside = [int(p) for p in places if 100 <= p < 3_000]
        assert matrix.count(token, 100, 3_000) == len(inside)
        assert matrix.occurrences(token, 100, 3_000) == inside
        if len(places):
            assert matrix.select(token, len(places) - 1) == places[-1]
    with pytest.raises(IndexError):
        matrix.select(17, 10_000)
    for few in ([], [0], [5], [70_000, 1]):
        assert WaveletMatrix(build(np.array(few, np.uint32))).decode().tolist() == few


def encode_plainly(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


ODD_TEXTS = [
    "it's a “quoted”  word\t\x1cé é İ İ <|endoftext|>abc<|startoftext|> ABC's don't 12ab",
    "",
    " \n\n",
    "日本語 текст ñandú!! ... x_y a'b ÿŸ ſ K ½ ß ẞ",
    "Thndou | ERHAHA!! to%%% the&&& 0x1F a--b ...",
    "a b c\x85d\x0be",
    None,
]


def test_words_apart_encode_like_whole_texts():
    encoder = token_files.Encoder(token_files.Settings(vocabulary(), kept_words=4))
    for text, want in zip(ODD_TEXTS, encode_plainly(ODD_TEXTS)):
        assert encoder.encode(text or "").tolist() == want


def test_shards_are_read_back_in_order(spark):
    rows = [(i * 7 % 50, f"document {i} " * (i % 9)) for i in range(50)]
    rows += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "repeated id")]
    docs = spark.createDataFrame(
        [(i, t, 0) for i, t in rows], "doc_id long, text string, start int"
    ).repartition(3)
    how = token_files.Settings(vocabulary(), shard_tokens=64)
    shards = token_files.write_shards(docs, how)
    assert shards.count() > 4
    got = [tuple(r) for r in token_files.read_documents(shards).orderBy("start").collect()]
    ids = {(i, t): [*e, 2] for (i, t), e in zip(rows, encode_plainly([t for _, t in rows]))}
    assert [r[0] for r in got] == sorted(i for i, _ in rows)
    at = 0
    want = {
        (i, len(e), zlib.crc32(np.array(e, "<u4").tobytes())) for (i, _), e in ids.items()
    }
    for doc_id, start, n, crc in got:
        assert start == at and (doc_id, n, crc) in want
        at += n
    assert token_files.read_documents(token_files.write_shards(docs.limit(0), how)).count() == 0


# Decontamination


def items_and_texts(percent, seed=2):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(2, 9))) for _ in range(900)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(12, 60)))) for i in range(60)]
    texts = []
    for i, item in items:
        words = item.split()
        for _ in range(len(words) * percent // 100):
            p = rnd.randrange(len(words))
            kind = rnd.randrange(3)
            if kind == 0:
                words[p] = rnd.choice(vocabulary)
            elif kind == 1:
                words.pop(p)
            else:
                words.insert(p, rnd.choice(vocabulary))
        around = [" ".join(rnd.choices(vocabulary, k=60)) for _ in range(2)]
        texts.append((i, f"{around[0]} {' '.join(words)} {around[1]}"))
    return items, texts


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@pytest.mark.parametrize(("percent", "recall"), [(0, 1.0), (10, 0.95), (18, 0.9)])
def test_recall_of_changed_items(percent, recall):
    items, texts = items_and_texts(percent)
    held = decontamination.prepare([i for i, _ in items], [t for _, t in items])
    found = decontamination.search(pa.array([t for _, t in texts]), held)
    hit = {(t, i) for t, i, _, _ in found}
    assert sum((n, i) in hit for n, (i, _) in enumerate(texts)) >= recall * len(texts)
    # Nothing is reported that the exact distance does not confirm.
    words = {i: t.split() for i, t in items}
    for t, i, first, d in found:
        text = texts[t][1].split()[first:]
        best = min(edit(words[i], text[:n]) for n in range(len(text) + 1))
        assert best == d <= len(words[i]) * 20 // 100


def test_distance_is_exact():
    rnd = random.Random(9)
    for _ in range(300):
        a = [rnd.randrange(4) for _ in range(rnd.randrange(1, 9))]
        b = [rnd.randrange(4) for _ in range(rnd.randrange(0, 12))]
        best = min(edit(a, b[:n]) for n in range(len(b) + 1))
        for most in (0, 1, 3):
            assert decontamination.distance(a, b, most) == (best if best <= most else None)


def test_matches_on_frames(spark):
    item = "Alpha bravo charlie delta echo foxtrot golf hotel india juliet"
    bench = spark.createDataFrame(
        [(7, item, 0), (8, None, 0), (9, "too short", 0), (7, item, 0)],
        "item_id long, text string, doc_id int",
    )
    rows = [(1, f"x {item.upper()}!! y"), (1, f"x {item.upper()}!! y"), (2, "clean words only")]
    rows += [(3, None), (4, ""), (None, item), (5, "word " * 30_000 + item)]
    docs = spark.createDataFrame(
        [(i, t, "c") for i, t in rows], "doc_id long, text string, row string"
    )
    small = decontamination.Settings(block_items=1)
    for how in (decontamination.Settings(), small):
        got = {tuple(r)[:3] for r in decontamination.matches(docs, bench, how=how).collect()}
        assert got == {(1, 7, 1), (None, 7, 0), (5, 7, 30_000)}
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
    assert decontamination.matches(docs.limit(0), bench).collect() == []
    assert decontamination.matches(docs, bench.limit(0)).collect() == []


def test_short_and_unspaced_items_are_found():
    items = ["What is the capital of Peru?", "Lima", "日本の首都はどこですか。", "東京は日本の首都であり、最大の都市です。", "?!", "กรุงเทพ", "one two"]
    held = decontamination.prepare(list(range(len(items))), items)
    texts = [
        "He asked: what is the CAPITAL of Peru -- Lima, of course, Lima.",
        "What is the capital of", "of Peru", None, "",
        "はい。日本の首都はどこですか？それは東京です。",
        "昔から東京は日本の首都であり、最大の街です。",
        "อยู่กรุงเทพมา", "two one", "limap", "日本 one", "two",
    ]
    found = {(t, i, w, d) for t, i, w, d in decontamination.search(pa.array(texts), held)}
    # One character more and two less: the fourth item is found by its edit distance.
    assert {x for x in found if x[1] != 3} == {(0, 0, 2, 0), (0, 1, 8, 0), (5, 2, 2, 0), (7, 5, 4, 0)}
    assert {x[:2] for x in found if x[1] == 3} == {(6, 3)}
    words, _, counts = decontamination._words(pa.array(["ab日本c。d", "é x", "𠀀𠀁"]))
    assert counts.tolist() == [5, 2, 2] and len(set(words.tolist())) == 9


# Mixing


def test_targets_are_reshared_until_none_is_above():
    mix = balancing.Mix()
    sizes = {"b": 10, "a": 1000, "d": 0, "c": 500, None: 300}
    targets = balancing.source_targets(sizes, mix)
    # Order a, b, c, d, NULL with weights 3, 1, 2, 3, 1.
    assert targets["d"] == 0 and targets["b"] == 20
    assert sum(targets.values()) == pytest.approx(1.5 * 1810)
    assert all(targets[s] <= 2 * sizes[s] for s in sizes)
    assert targets["a"] / 3 == pytest.approx(targets["c"] / 2) or targets["c"] == 1000


def mix_rows(n=3000):
    rnd = random.Random(5)
    sources = ["s1"] * 5 + ["s2", "s3", None]
    return [
        (i, " ".join(["w"] * int(rnd.paretovariate(1.2) * 20)), rnd.choice(sources))
        for i in range(n)
    ]


def test_words_taken_come_near_their_targets(spark):
    rows = mix_rows() + [(9000, None, "s1"), (9001, "", "empty"), (7, "w w", "s1"), (7, "w w", "s1")]
    docs = spark.createDataFrame(
        [(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int"
    )
    got = balancing.mix_sizes(docs).collect()
    assert len(got) == len(rows)
    source = {i: s for i, _, s in rows}
    total, target = Counter(), {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        total[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    for s in target:
        assert abs(total[s] - target[s]) <= max(5, 0.005 * target[s]), s
    again = balancing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert balancing.mix_sizes(docs.limit(0)).collect() == []


def test_mixed_documents_are_repeated_with_their_columns(spark):
    rows = mix_rows(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["copies"] for r in balancing.mix_sizes(docs).collect()}
    mixed = balancing.mix_documents(docs)
    assert mixed.columns == docs.columns
    count = Counter(r["doc_id"] for r in mixed.collect())
    assert count == Counter({i: n for i, n in taken.items() if n})


def test_rows_that_nothing_tells_apart_are_rounded_one_by_one(spark):
    docs = spark.range(10200).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.when(F.col("id") < 1000, "w " * 10).otherwise("v " * 4).alias("text"),
        F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"),
    )
    mix = balancing.Mix(weights=(1, 4), total_percent=110)
    got = balancing.mix_sizes(docs, mix=mix)
    assert got.count() == 10200
    sums = got.groupBy("source_size").agg(F.sum("taken"), F.max("target")).collect()
    assert len(sums) == 2
    for _, taken, target in sums:
        assert taken == pytest.approx(target, rel=0.005)
    mixed = balancing.mix_documents(docs, mix=mix)
    assert mixed.columns == docs.columns
    copies = got.groupBy("size").agg(F.sum("copies").alias("n")).collect()
    made = {r["text"].count(" "): r["count"] for r in mixed.groupBy("text").count().collect()}
    assert made == {r["size"]: r["n"] for r in copies}


def test_rounding_against_rows_one_by_one(spark):
    """Units of equal rows take what their rows would take one after the other."""
    rnd = random.Random(3)
    rows = [(i % 40, "x " * rnd.randrange(9), rnd.choice("ab")) for i in range(400)]
    rows += rows[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = balancing.Mix(weights=(5, 2), total_percent=70)
    got = balancing.mix_sizes(docs, mix=mix).collect()
    by_source = {r["source_size"]: [] for r in got}
    for r in got:
        by_source[r["source_size"]].append(r)
    for parts in by_source.values():
        rate, over, taken = parts[0]["rate"], 0.0, 0
        # With one group a source, only sizes decide what the rows in order take.
        for size in sorted((r["size"] for r in parts), reverse=True):
            low = int(rate)
            want = rate * size - over
            n = low + (size > 0 and want - low * size > size / 2)
            over = n * size - want
            taken += n * size
        assert sum(r["taken"] for r in parts) == taken
        assert abs(taken - parts[0]["target"]) <= 5


def test_features_reach_their_mean(spark):
    rnd = random.Random(1)
    rows = [(i, f"s{i % 3}", rnd.randrange(10, 200), rnd.random()) for i in range(900)]
    units = spark.createDataFrame(rows, "doc_id long, source string, size long, score double")
    sizes = Counter()
    for _, s, n, _ in rows:
        sizes[s] += n
    mix = balancing.Mix(total_percent=90)
    targets = balancing.source_targets(sizes, mix)
    multiplier, tilt = balancing.solve(units, sizes, targets, mix, {"score": 0.6})
    words = Counter()
    score = 0.0
    for _, s, n, x in rows:
        rate = min(2.0, float(np.exp(multiplier[s] + tilt[0] * x)))
        words[s] += n * rate
        score += n * rate * x
    for s in sizes:
        assert words[s] == pytest.approx(targets[s], rel=1e-4)
    assert score / sum(words.values()) == pytest.approx(0.6, abs=1e-4)
