"""Removal of long repeated byte strings by blockwise suffix sorting with a cover sample.

A byte is removed if it lies in a string of ``length`` bytes that also starts elsewhere.
Sorting all suffixes to that depth would tell, but most suffixes have no partner. So the
suffixes are sorted in buckets, one at a time, and the difference cover decides which ones
have to be sorted at all:

A difference cover D modulo v has, for any two positions i and j, a shift below v at which
both are in the cover. If the ``length`` bytes at i and j are equal, so are the
``length - v + 1`` bytes at those two cover positions. The cover sample therefore is ranked
first (sample suffixes are sorted by bucket, equal ones tie), and a suffix is a candidate
only if a sample position within v bytes of it tied. Candidates, one tenth of the bytes or
so, are sorted by bucket to full depth; those that tie are the repeated strings.

Texts are staged once, in packs: rows of one input task, cut by bytes at the ends of texts.
A pack sorts the fingerprints of its suffixes and sends each distinct one once, with a bit
that tells whether the pack has it twice; the bucket answers with one bit for each of them.
So a string costs a bucket at most one fingerprint a pack, however often it repeats, and
periodic text (rule lines, padding, one passage again and again) sends next to nothing.
A bucket is chosen by one hash and sorted by another of 64 bits, and the number of buckets
grows with the packs, so chance ties stay improbable at any size. Memory is bounded by a
pack, or by one text that is longer, and by a bucket.

Defined results: NULL and empty texts have no bytes and nothing removed; repeated rows and
copies of at least ``length`` bytes are removed whole, each of them; shorter texts never
match; strings do not cross texts; a text is handled whole whatever its length.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.buffers import BLOCK, Prefix, utf8
from strata.llm.frames import staged
from strata.sources.tables import new_folder


@dataclass(frozen=True)
class Settings:
    """``cover`` is a perfect difference set modulo ``period``."""

    length: int = 400
    period: int = 133
    cover: tuple[int, ...] = (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
    buckets_per_pack: int = 4
    pack_bytes: int = 16 << 20

    @property
    def sample_length(self) -> int:
        return self.length - self.period + 1


_SENT = "part int, pack long, n int, block binary"
_ANSWER = "pack long, kind int, part int, bits binary"


class Pack:
    """The texts of one pack in row order, and what has to be computed from them anew."""

    def __init__(self, rows: pa.Table, how: Settings, parts: int):
        rows = rows.sort_by("row").combine_chunks()
        self.how, self.parts = how, parts
        column = rows.column("text").combine_chunks()
        self.ids = rows.column("doc_id")
        self.data, self.offsets = utf8(column)

    def sample(self) -> np.ndarray:
        """Cover positions that have a whole sample string in their text."""
        how, out = self.how, []
        cover = np.array(how.cover, dtype=np.int64)
        for start, end in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            last = end - start - how.sample_length
            # A text below the full length has no string to lose.
            if end - start < how.length:
                continue
            at = np.arange(0, last + 1, how.period, dtype=np.int64)[:, None] + cover
            at = at.ravel()
            out.append(start + at[at <= last])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def fingerprints(
        self, at: np.ndarray, length: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and 64-bit fingerprint of the strings at ascending positions."""
        part = np.empty(len(at), dtype=np.uint16 if self.parts <= 65536 else np.uint32)
        print_ = np.empty(len(at), dtype=np.uint64)
        for start in range(0, len(self.data), BLOCK):
            end = min(start + BLOCK, len(self.data))
            first, last = np.searchsorted(at, (start, end))
            if first == last:
                continue
            piece = self.data[start : end + length]
            s = at[first:last] - start
            h = Prefix(piece, 1).hashes(s, s + length) >> np.uint64(24)
            part[first:last] = (h % np.uint64(self.parts)).astype(part.dtype)
            print_[first:last] = Prefix(piece, 0).hashes(s, s + length)
        return part, print_

    def distinct(
        self, at: np.ndarray, length: int, width: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fingerprints of ``width`` bytes, sorted by bucket.

        The sorted places in ``at``, where each distinct value begins among them, the
        values, and where each bucket begins among the values.
        """
        part, print_ = self.fingerprints(at, length)
        if width < 8:
            print_ &= np.uint64((1 << 8 * width) - 1)
        order = np.argsort(print_)
        order = order[np.argsort(part[order], kind="stable")]
        part, print_ = part[order], print_[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (print_[1:] != print_[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        cuts = np.searchsorted(part[first], np.arange(self.parts + 1))
        return order, first, print_[first], cuts

    def blocks(self, pack: int, at: np.ndarray, length: int, width: int) -> pa.Table:
        """Distinct fingerprints and a bit for those of several places, by bucket."""
        _, first, print_, cuts = self.distinct(at, length, width)
        twice = np.diff(first, append=len(at)) > 1
        raw = print_.view(np.uint8).reshape(-1, 8)[:, :width]
        data = np.ascontiguousarray(raw).tobytes()
        full = np.flatnonzero(np.diff(cuts))
        return pa.table(
            {
                "part": pa.array(full.astype(np.int32)),
                "pack": pa.array(np.full(len(full), pack, dtype=np.int64)),
                "n": pa.array(np.diff(cuts)[full].astype(np.int32)),
                "block": pa.array(
                    [
                        data[cuts[p] * width : cuts[p + 1] * width]
                        + np.packbits(twice[cuts[p] : cuts[p + 1]]).tobytes()
                        for p in full
                    ],
                    pa.binary(),
                ),
            }
        )

    def tied(
        self, at: np.ndarray, length: int, width: int, answers: dict[int, bytes]
    ) -> np.ndarray:
        """Of the positions those whose string also starts elsewhere."""
        order, first, _, cuts = self.distinct(at, length, width)
        flag = np.zeros(len(first), dtype=bool)
        for p, bits in answers.items():
            held = slice(int(cuts[p]), int(cuts[p + 1]))
            n = held.stop - held.start
            flag[held] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
        return at[np.sort(order[np.repeat(flag, np.diff(first, append=len(at)))])]

    def candidates(self, tied: np.ndarray) -> np.ndarray:
        """Starts of full strings that have a tied sample position within the period."""
        if not len(tied):
            return tied
        text = np.searchsorted(self.offsets, tied, side="right") - 1
        first = np.maximum(tied - self.how.period + 1, self.offsets[text])
        last = np.minimum(tied, self.offsets[text + 1] - self.how.length)
        first[1:] = np.maximum(first[1:], np.maximum.accumulate(last)[:-1] + 1)
        count = np.maximum(last - first + 1, 0)
        begin = np.repeat(first - (np.cumsum(count) - count), count)
        return begin + np.arange(len(begin))

    def removed(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal runs of bytes inside the strings at ascending ``starts``."""
        if not len(starts):
            return starts, starts
        text = np.searchsorted(self.offsets, starts, side="right") - 1
        gap = (np.diff(starts) > self.how.length) | (np.diff(text) > 0)
        first = starts[np.concatenate([[True], gap])]
        last = starts[np.concatenate([gap, [True]])] + self.how.length
        return first, last


def _answers(rows: pa.Table, kind: int) -> dict[int, bytes]:
    chosen = rows.filter(pc.equal(rows.column("kind"), kind))
    return dict(zip(chosen.column("part").to_pylist(), chosen.column("bits").to_pylist()))


def _sort_bucket(kind: int, width: int):
    """Sort one bucket and answer each block with a bit for every tie."""

    def run(rows: pa.Table) -> pa.Table:
        blocks = rows.column("block").to_pylist()
        sizes = rows.column("n").to_numpy().astype(np.int64)
        raw = np.zeros((int(sizes.sum()), 8), dtype=np.uint8)
        tie = np.zeros(len(raw), dtype=bool)
        ends = np.cumsum(sizes)
        for block, end, n in zip(blocks, ends.tolist(), sizes.tolist()):
            bytes_ = np.frombuffer(block, np.uint8)
            raw[end - n : end, :width] = bytes_[: n * width].reshape(n, width)
            tie[end - n : end] = np.unpackbits(bytes_[n * width :], count=n)
        value = raw.view(np.uint64).ravel()
        order = np.argsort(value)
        ranked = value[order]
        equal = ranked[1:] == ranked[:-1]
        tie[order[1:]] |= equal
        tie[order[:-1]] |= equal
        out = []
        for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
            mine = tie[end - size : end]
            if mine.any():
                out.append((i, np.packbits(mine).tobytes()))
        index = pa.array([i for i, _ in out], pa.int32())
        return pa.table(
            {
                "pack": rows.column("pack").take(index),
                "kind": pa.array([kind] * len(out), pa.int32()),
                "part": rows.column("part").take(index),
                "bits": pa.array([b for _, b in out], pa.binary()),
            }
        )

    return run


def _in_packs(docs: DataFrame, how: Settings) -> DataFrame:
    """The texts with the pack they belong to and their row in their input task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, held, row = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            packs = []
            for size in sizes:
                if held and held + size > how.pack_bytes:
                    pack, held = pack + 1, 0
                held += size
                packs.append(pack)
            rows = np.arange(row, row + len(packs), dtype=np.int64)
            row += len(packs)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(packs, pa.int64()), pa.array(rows)],
                names=["doc_id", "text", "pack", "row"],
            )

    return docs.mapInArrow(run, "doc_id long, text string, pack long, row long")


def _stage_packs(docs: DataFrame, how: Settings) -> tuple[DataFrame, int, str]:
    """Write the texts once, bucketed by pack, and count the packs.

    Later steps meet the answers of the buckets without moving the texts again.
    """
    spark = docs.sparkSession
    tasks = max(1, docs.rdd.getNumPartitions())
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"packs_{uuid.uuid4().hex}"
    (
        _in_packs(docs, how)
        .write.option("compression", "zstd")
        .option("path", new_folder(spark, "packs"))
        .bucketBy(min(max(tasks, shuffles), 10_000), "pack")
        .saveAsTable(name)
    )
    packs = spark.table(name)
    return packs, packs.select("pack").distinct().count(), name


def repeated_strings(
    docs: DataFrame, id: str = "doc_id", text: str = "text", how: Settings = Settings()
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, spans, kept.

    ``spans`` are the maximal removed runs as ``start, end`` in bytes of the text, and
    ``kept`` is the hash of the bytes that stay.
    """
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packs, n_packs, name = _stage_packs(chosen, how)
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(1 << 16, max(how.buckets_per_pack * n_packs, shuffles))

    def sample_blocks(key: tuple, rows: pa.Table) -> pa.Table:
        pack = Pack(rows, how, parts)
        return pack.blocks(key[0].as_py(), pack.sample(), how.sample_length, 5)

    sent = packs.groupBy("pack").applyInArrow(sample_blocks, _SENT)
    ranks = staged(
        sent.groupBy("part").applyInArrow(_sort_bucket(0, 5), _ANSWER), "cover-ties"
    )

    def candidate_starts(pack: Pack, answers: pa.Table) -> np.ndarray:
        tied = pack.tied(pack.sample(), how.sample_length, 5, _answers(answers, 0))
        return pack.candidates(tied)

    def candidate_blocks(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        pack = Pack(rows, how, parts)
        starts = candidate_starts(pack, answers)
        return pack.blocks(key[0].as_py(), starts, how.length, 8)

    sent = _cogrouped(packs, ranks, candidate_blocks, _SENT)
    ties = staged(
        sent.groupBy("part").applyInArrow(_sort_bucket(1, 8), _ANSWER), "string-ties"
    )

    def results(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        pack = Pack(rows, how, parts)
        starts = candidate_starts(pack, answers)
        first, last = pack.removed(
            pack.tied(starts, how.length, 8, _answers(answers, 1))
        )
        n_bytes, spans, kept = [], [], []
        cuts = np.searchsorted(first, pack.offsets)
        for i in range(len(pack.offsets) - 1):
            begin, end = int(pack.offsets[i]), int(pack.offsets[i + 1])
            digest, at, mine = hashlib.sha256(), begin, []
            for a, b in zip(
                first[cuts[i] : cuts[i + 1]].tolist(), last[cuts[i] : cuts[i + 1]].tolist()
            ):
                digest.update(pack.data[at:a].tobytes())
                mine.append({"start": a - begin, "end": b - begin})
                at = b
            digest.update(pack.data[at:end].tobytes())
            n_bytes.append(end - begin)
            spans.append(mine)
            kept.append(digest.hexdigest())
        return pa.table(
            {
                "doc_id": pack.ids,
                "n_bytes": pa.array(n_bytes, pa.int64()),
                "spans": pa.array(
                    spans,
                    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                ),
                "kept": pa.array(kept, pa.string()),
            }
        )

    found = _cogrouped(
        packs,
        ranks.unionAll(ties),
        results,
        "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept string",
    )
    # The name was needed to read by bucket; the files stay for the returned frame.
    docs.sparkSession.sql(f"DROP TABLE {name}")
    return found


def _cogrouped(packs: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """Run over each pack with its answers; only the answers are shuffled."""
    both = packs.groupBy("pack").cogroup(answers.groupBy("pack"))
    return both.applyInArrow(run, schema)
