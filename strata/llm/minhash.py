"""MinHash near-duplicates with Odd sketches.

A text is the set of its distinct five-word shingles. MinHash samples of the set are cut
into bands; texts that agree on a whole band are candidates. The same samples are folded
into a parity bitmap, the Odd sketch: the population count of the XOR of two sketches
estimates the similarity, and candidates far below the limit go without reading their sets.
What is left is confirmed on the full sets, so every link is exact.

No bucket is expanded into its pairs. Texts with equal sets are one node. In a first round
each bucket links its members to its smallest node. Buckets whose members are then of one
component are done; in the others only pairs of different components are tested, with a
sketch of many more samples inside the join, so a bucket costs pairs only as far as it is not one group. Of
these, pairs go untested where too few shingles of one of them occur in any other
component: texts at the rim of a large group have mostly edits of their own. Hence no link
between candidates is lost, while a group of near copies costs its size.

Recall: with 32 bands of 4 a pair at the limit of 0.75 misses every band with probability
5e-6, and at 0.8 with 5e-8. The limits of the coarse and the fine sketches lie more than
4.5 deviations of their estimates below the similarity limit.

Defined results: NULL, empty and blank texts have an empty set and are linked with nothing;
a text of fewer than five words is one shingle of all its words; rows are told apart by a
hash of id and text, so rows that repeat an id and rows without id are linked each by its
own text. A component has the smallest id in it as its name, NULL if no row of it has an id;
rows that repeat that id in it are all marked as kept, and rows without id never are.
``drop_duplicates`` keeps one row of every component, whether it has an id or not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.buffers import BLOCK, blocks, mix, utf8, word_hashes
from strata.llm.components import roots
from strata.llm.frames import keys, staged


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    sketch_words: int = 8
    sketch_percent: int = 50
    fine_samples: int = 2048
    fine_words: int = 128
    fine_percent: int = 69
    seed: int = 11

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def most_bits(samples: int, words: int, percent: int) -> int:
    """Differing bits of two sketches that are expected at a similarity."""
    bits = 64 * words
    differing = 2 * samples * (1 - percent / 100)
    return math.ceil(bits / 2 * (1 - math.exp(-2 * differing / bits)))


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, words: int = 5
) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z in lower case."""
    hashes, _, _, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    # One odd factor for each place of a word in a shingle.
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes) - words + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(words if n > 0 else 0):
        rolled += hashes[j : j + n] * factors[j]
    rolled = mix(rolled)
    sets = []
    for end, count in zip(ends.tolist(), counts.tolist()):
        first = end - count
        if count >= words:
            sets.append(np.unique(rolled[first : end - words + 1]))
        elif count:
            short = (hashes[first:end] * factors[:count]).sum(dtype=np.uint64)
            # Told from a longer sequence by its length.
            sets.append(mix(np.array([short + np.uint64(count)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _signatures(sets: list[np.ndarray], samples: int, seed: int) -> np.ndarray:
    """MinHash samples, a row for each set; an empty set has a row of no meaning."""
    random = np.random.default_rng(seed)
    factor = random.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2)
    factor += np.uint64(1)
    add = random.integers(0, 1 << 63, samples, dtype=np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    out = np.zeros((len(sets), samples), dtype=np.uint64)
    if not full:
        return out
    joined = np.concatenate([sets[i] for i in full])
    starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    found = np.empty((samples, len(full)), dtype=np.uint64)
    held = np.empty_like(joined)
    for j in range(samples):
        np.multiply(joined, factor[j], out=held)
        held += add[j]
        np.minimum.reduceat(held, starts, out=found[j])
    out[full] = found.T
    return out


def _bands(signatures: np.ndarray, how: Settings) -> np.ndarray:
    """A bucket for each band, the band's number in it."""
    grouped = signatures.reshape(-1, how.bands, how.rows)
    factors = mix(np.arange(100, 100 + how.rows, dtype=np.uint64)) | np.uint64(1)
    number = mix(np.arange(1, how.bands + 1, dtype=np.uint64))
    return mix((grouped * factors).sum(axis=2, dtype=np.uint64) + number)


def odd_sketches(signatures: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmaps: each sample flips one bit, chosen by its place and value."""
    (n, samples), bits = signatures.shape, 64 * words
    place = mix(np.arange(1, samples + 1, dtype=np.uint64))
    at = (mix(signatures + place) % np.uint64(bits)).astype(np.int64)
    flat = (np.arange(n)[:, None] * bits + at).ravel()
    parity = np.bincount(flat, minlength=n * bits).astype(np.uint8) & 1
    packed = np.packbits(parity.reshape(n, bits), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """A two-dimensional array as lists of longs."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    values = np.ascontiguousarray(rows).view(np.int64).ravel()
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _features(docs: DataFrame, how: Settings) -> DataFrame:
    """Per row: set size, a 128-bit key of the set, bands and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in blocks(offsets):
                part = data[offsets[first] : offsets[last]]
                sets = shingle_sets(
                    part, offsets[first : last + 1] - offsets[first], how.words
                )
                found = _signatures(sets, how.samples, how.seed)
                keys = [
                    np.array(
                        [f(s) if len(s) else 0 for s in sets], dtype=np.uint64
                    ).view(np.int64)
                    for f in (
                        lambda s: s.sum(dtype=np.uint64),
                        lambda s: mix(s ^ np.uint64(how.seed)).sum(dtype=np.uint64),
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *[pa.array(k) for k in keys],
                        _lists(_bands(found, how)),
                        _lists(odd_sketches(found, how.sketch_words)),
                    ],
                    names=["doc_id", "row", "n_shingles", "k1", "k2", "bands", "sketch"],
                )

    return docs.mapInArrow(
        run,
        "doc_id long, row long, n_shingles long, k1 long, k2 long, bands array<long>, "
        "sketch array<long>",
    )


def _sets(docs: DataFrame, how: Settings) -> DataFrame:
    """The full set of each row, for confirming links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in blocks(offsets):
                part = data[offsets[first] : offsets[last]]
                sets = shingle_sets(
                    part, offsets[first : last + 1] - offsets[first], how.words
                )
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2).slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    ],
                    names=["node", "shingles"],
                )

    return docs.mapInArrow(run, "node long, shingles array<long>")


def _fine_sketches(sets: DataFrame, how: Settings) -> DataFrame:
    """Sketches of many samples for a few nodes, from their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = batch.column(1)
            for first, last in blocks(np.array(shingles.offsets), BLOCK // 8):
                part = [
                    x.values.to_numpy().view(np.uint64)
                    for x in shingles.slice(first, last - first)
                ]
                found = _signatures(part, how.fine_samples, how.seed + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        _lists(odd_sketches(found, how.fine_words)),
                    ],
                    names=["node", "fine"],
                )

    return sets.mapInArrow(run, "node long, fine array<long>")


def _differing(a: Column, b: Column, words: int) -> Column:
    return reduce(
        lambda x, y: x + y,
        [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(words)],
    )


def _differing_fine(a: Column, b: Column) -> Column:
    """The same for long sketches, where a term for each word would be too much code."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + x)


def _close(a: str, b: str, how: Settings) -> Column:
    """Whether sizes allow the similarity and the sketches do not speak against it."""
    sizes = [F.col(f"{x}.n_shingles") for x in (a, b)]
    sketches = [F.col(f"{x}.sketch") for x in (a, b)]
    return (100 * F.least(*sizes) >= how.percent * F.greatest(*sizes)) & (
        _differing(*sketches, how.sketch_words)
        <= most_bits(how.samples, how.sketch_words, how.sketch_percent)
    )


def _full_sets(docs: DataFrame, nodes: DataFrame, how: Settings) -> DataFrame:
    """Staged sets of the nodes, read from the texts again."""
    nodes = keys(nodes, "minhash-keys")
    texts = docs.join(nodes, F.col("row") == F.col("node"), "left_semi")
    return staged(_sets(texts, how), "shingle-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, how: Settings) -> DataFrame:
    """Of the pairs ``(u, v)`` those whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - both
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .filter(100 * both >= how.percent * union)
        .select("u", "v")
    )


def _shareable(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """How many shingles of each node also occur in a node of another component.

    No node can have more in common with any node that it is not yet tied to.
    """
    each = sets.join(labels, "node").select(
        "node", "root", F.explode("shingles").alias("shingle")
    )
    spread = (
        each.groupBy("shingle")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("shingle")
    )
    return (
        each.join(spread, "shingle", "left_semi")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("shareable"))
    )


def _row_key(id: Column, text: Column) -> Column:
    """Tells rows apart; those of equal id and text are copies and share one."""
    return F.xxhash64(id.isNull(), id, text)


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", how: Settings = Settings()
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id and kept."""
    return _labelled(docs, id, text, how).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _labelled(docs: DataFrame, id: str, text: str, how: Settings) -> DataFrame:
    """One row per input row: doc_id, row, n_shingles, component_id and chosen.

    ``chosen`` is the row key of the one row of the component that stays, the one with
    the smallest id; NULL for rows without shingles, which are copies of nothing.
    """
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("row", _row_key(F.col("doc_id"), F.col("text")))
    features = staged(_features(docs, how), "minhash")
    full = features.filter(F.col("n_shingles") > 0)
    # Texts with equal sets are one node: the row with the smallest id.
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    classes = staged(
        full.groupBy("k1", "k2")
        .agg(best.alias("best"))
        .select("k1", "k2", F.col("best.row").alias("node"), "best"),
        "minhash-classes",
    )
    nodes = staged(
        full.join(classes, ["k1", "k2"])
        .filter(F.col("row") == F.col("node"))
        .select("node", "n_shingles", "bands", "sketch")
        .dropDuplicates(["node", "bands"]),
        "minhash-nodes",
    )
    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    hubs = banded.groupBy("bucket").agg(
        F.min("node").alias("hub"), F.max("node").alias("last")
    )
    shared = staged(
        banded.join(
            hubs.filter(F.col("hub") != F.col("last")).drop("last"), "bucket"
        ),
        "minhash-buckets",
    )
    sketches = nodes.select("node", "n_shingles", "sketch")
    stars = (
        shared.filter(F.col("node") != F.col("hub"))
        .select("node", "hub")
        .distinct()
        .join(sketches.alias("a"), "node")
        .join(sketches.withColumnRenamed("node", "hub").alias("b"), "hub")
        .filter(_close("a", "b", how))
        .select(F.col("node").alias("u"), F.col("hub").alias("v"))
        .distinct()
    )
    # Every confirmation needs only the text of a node's own row.
    stars = staged(stars, "candidates")
    ends = stars.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = staged(_confirmed(stars, _full_sets(docs, ends, how), how), "links")
    first = roots(links)
    narrow = _mixed_buckets(shared, first)
    members = narrow.select("node", "root").distinct()
    sets = _full_sets(docs, members.select("node"), how)
    # A node cannot be more similar to any other than its shareable part is to itself.
    able = staged(
        _shareable(sets, members)
        .join(nodes.select("node", "n_shingles"), "node")
        .filter(100 * F.col("shareable") >= how.percent * F.col("n_shingles")),
        "minhash-able",
    )
    narrow = staged(
        _several(narrow.join(able.select("node"), "node", "left_semi")), "minhash-narrow"
    )
    left = keys(narrow.select("node").distinct(), "minhash-keys")
    known = (
        able.join(left, "node", "left_semi")
        .join(_fine_sketches(sets.join(left, "node", "left_semi"), how), "node")
        .join(nodes.select("node", "bands", "sketch"), "node")
    )
    mixed = staged(narrow.join(known, "node"), "minhash-mixed")
    most = F.least("a.shareable", "b.shareable")
    # A pair is tested in the first band that it shares.
    same = F.zip_with("a.bands", "b.bands", lambda x, y: x == y)
    rest = (
        mixed.alias("a")
        .join(
            mixed.alias("b"),
            (F.col("a.bucket") == F.col("b.bucket"))
            & (F.col("a.root") < F.col("b.root"))
            & (
                100 * most
                >= how.percent * (F.col("a.n_shingles") + F.col("b.n_shingles") - most)
            )
            & _close("a", "b", how)
            & (
                _differing_fine(F.col("a.fine"), F.col("b.fine"))
                <= most_bits(how.fine_samples, how.fine_words, how.fine_percent)
            )
            & (F.array_position(same, F.lit(True)) == F.col("a.band") + 1),
        )
        .select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
        .distinct()
    )
    more = staged(_confirmed(staged(rest, "candidates"), sets, how), "links")
    last = roots(links.unionAll(more)) if not more.isEmpty() else first
    rooted = classes.join(last, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    # Nodes are numbered by hashes, so the smallest id of a component is found here.
    names = rooted.groupBy("root").agg(F.min("best").alias("first"))
    labelled = rooted.select("k1", "k2", "root").join(names, "root").drop("root")
    return (
        features.select("doc_id", "row", "n_shingles", "k1", "k2")
        .join(labelled, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "row",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("first.doc_id"))
            .otherwise(F.col("doc_id"))
            .alias("component_id"),
            F.when(F.col("n_shingles") > 0, F.col("first.row")).alias("chosen"),
        )
    )


def _several(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    several = (
        members.groupBy("bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("bucket")
    )
    return members.join(several, "bucket")


def _mixed_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, but for their hubs.

    The pairs with a hub have been tested.
    """
    rooted = shared.join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    others = rooted.filter(F.col("node") != F.col("hub")).drop("hub")
    return staged(_several(others), "minhash-members")


def drop_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", how: Settings = Settings()
) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id.

    Of rows with that id the one with the smallest row key stays, and of rows of equal id
    and text one. Rows without shingles are copies of nothing and all stay, but one of
    those that have an id and are equal in id and text.
    """
    labels = staged(_labelled(docs, id, text, how).select("doc_id", "row", "chosen"), "labels")
    kept = labels.filter(
        F.coalesce(F.col("row") == F.col("chosen"), F.col("chosen").isNull())
    )
    each = F.col("chosen").isNull() & F.col("doc_id").isNull()
    counted = (
        kept.groupBy(F.col("row").alias("kept_row"))
        .agg(F.count(F.lit(1)).alias("n"), F.bool_and(each).alias("each"))
        .select("kept_row", (F.col("each") | (F.col("n") == 1)).alias("whole"))
    )
    whole, repeated = (
        keys(counted.filter(which).select("kept_row"), "kept-rows")
        for which in ("whole", "not whole")
    )
    key = _row_key(docs[id].cast("long"), docs[text])
    # Most rows stay as they are; only rows of equal id and text have to meet.
    stay = docs.join(whole, key == F.col("kept_row"), "left_semi")
    # Maps have no hash.
    hashed = [docs[c] for c, kind in docs.dtypes if "map<" not in kind]
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.xxhash64(*hashed).alias("tie"),
        key.alias("key"),
    ).join(repeated, F.col("key") == F.col("kept_row"), "left_semi")
    single = packed.groupBy("key").agg(F.min_by("row", "tie").alias("row"))
    return stay.unionAll(single.select("row.*"))
