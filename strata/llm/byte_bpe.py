"""Byte-level BPE by a global shuffle of distinct words.

Merges of byte-level BPE never leave a pre-token, and most pre-tokens are one of few
words. So texts are cut into pre-tokens block by block, and a block keeps for every
position the number of its word, in the order in which the block first saw it. The
distinct words of all blocks are dealt by a hash, exploded to rows with their block and
number, and sorted, so that each distinct word is encoded once as its rows stream by. Its
ids go back to the blocks, which put them together by position.

A block sends a word once, however often it occurs: the most frequent word costs one row a
block, as any other that is in every block, and no task gathers more than a block and its
words. Positions never move: blocks are written once, bucketed by block, and the ids meet
them there.

Decoding joins the table of token bytes, which has as many rows as the vocabulary, on the
map side of every task.

Defined results: NULL and empty texts have no ids, and no or NULL ids have no bytes; rows
are encoded each by itself, whatever their id, repeated ones as well; bytes that are not
UTF-8 are read as replacement characters; an id that the vocabulary lacks has no bytes; a
long text is cut in pieces that cannot share a pre-token, and its ids come as one row; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.buffers import BLOCK, blocks, utf8
from strata.llm.pretokens import words
from strata.sources.tables import new_folder


@dataclass(frozen=True)
class Settings:
    """``ranks`` is the path of a rank file, the same on every machine."""

    ranks: str
    block_bytes: int = 32 << 20


@cache
def rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


@cache
def _encoder(path: str) -> tiktoken.Encoding:
    """Merges for one pre-token at a time: its pattern takes whatever it is given."""
    return tiktoken.Encoding(
        "words", pat_str=r"[\s\S]+", mergeable_ranks=rank_table(path), special_tokens={}
    )


@cache
def _token_bytes(path: str) -> pa.Array:
    """Bytes by id; an id that the file lacks has none."""
    ranks = rank_table(path)
    table = [b""] * (max(ranks.values(), default=-1) + 2)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


#: Of a block either a run of texts with the numbers of their words, or the words that go
#: to one part. Whole numbers are packed.
_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("row", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("positions", pa.binary()),
        ("part", pa.int32()),
        ("steps", pa.binary()),
        ("lengths", pa.binary()),
        ("words", pa.binary()),
    ]
)
_BLOCK_DDL = (
    "block long, row long, doc_ids array<long>, counts array<long>, positions binary, "
    "part int, steps binary, lengths binary, words binary"
)
_ANSWERS = pa.schema(
    [("block", pa.int64()), *[(n, pa.binary()) for n in ("steps", "lengths", "ids")]]
)
_ANSWERS_DDL = "block long, steps binary, lengths binary, ids binary"


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as planes of their low bytes, the next, and so on.

    Only planes that are used are held; bytes that are alike lie together and compress.
    """
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    used = max((i + 1 for i in range(4) if planes[i].any()), default=1)
    return bytes([used]) + np.ascontiguousarray(planes[:used]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    wide = np.zeros((raw.shape[1], 4), dtype=np.uint8)
    wide[:, : data[0]] = raw.T
    return wide.view("<u4").ravel()


class Block:
    """Texts of one block, and the words it has seen, numbered in that order."""

    def __init__(self, block: int) -> None:
        self.block, self.rows, self.held = block, 0, 0
        self.known: dict[int, int] = {}
        self.words: list[bytes] = []

    def add(self, ids: pa.Array, data: bytes, offsets: np.ndarray) -> pa.RecordBatch:
        try:
            data.decode()
        except UnicodeDecodeError:
            cuts = offsets.tolist()
            texts = [
                data[a:b].decode(errors="replace").encode() for a, b in zip(cuts, cuts[1:])
            ]
            data, offsets = b"".join(texts), np.cumsum([0] + [len(t) for t in texts])
        begin, hashes = words(data, offsets)
        code, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), dtype=np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        before, known = len(self.known), self.known
        number = np.array(
            [known.setdefault(h, len(known)) for h in distinct.tolist()], dtype=np.int64
        )
        fresh = first[number >= before]
        end = np.append(begin[1:], len(data))
        self.words += [data[a:b] for a, b in zip(begin[fresh].tolist(), end[fresh].tolist())]
        self.held += len(data)
        self.rows += 1
        row = {
            "block": self.block,
            "row": self.rows,
            "doc_ids": ids.to_pylist(),
            "counts": np.diff(np.searchsorted(begin, offsets)),
            "positions": packed(number[code]),
        }
        return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

    def sent(self, parts: int) -> pa.RecordBatch:
        """The words by the part they go to, which is the same in every block."""
        part = np.fromiter(self.known, np.uint64, len(self.known)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        full, first = np.unique(part[order], return_index=True)
        rows = [
            {
                "block": self.block,
                "part": int(p),
                "steps": packed(np.diff(mine, prepend=0)),
                "lengths": packed(np.array([len(self.words[i]) for i in mine])),
                "words": b"".join([self.words[i] for i in mine]),
            }
            for p, mine in zip(full, np.split(order, first[1:]) if len(full) else [])
        ]
        return pa.RecordBatch.from_pylist(rows, schema=_BLOCK)


def _give_back() -> None:
    """Return freed memory of Arrow to the system; workers stay for the next stage."""
    pa.default_memory_pool().release_unused()


def _in_blocks(docs: DataFrame, how: Settings) -> DataFrame:
    """Write positions and words once, bucketed by block."""
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * shuffles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in blocks(offsets, min(BLOCK, how.block_bytes)):
                size = int(offsets[last] - offsets[first])
                if held.rows and held.held + size > how.block_bytes:
                    yield held.sent(parts)
                    held = Block(held.block + 1)
                    _give_back()
                bounds = offsets[first : last + 1] - offsets[first]
                piece = data[offsets[first] : offsets[last]].tobytes()
                yield held.add(batch.column(0).slice(first, last - first), piece, bounds)
            del data
            _give_back()
        sent = held.sent(parts)
        del held
        yield sent
        del sent
        _give_back()

    name = f"words_{uuid.uuid4().hex}"
    (
        docs.mapInArrow(run, _BLOCK_DDL)
        .write.option("compression", "zstd")
        .option("path", new_folder(spark, "words"))
        .bucketBy(min(shuffles, 10_000), "block")
        .saveAsTable(name)
    )
    return spark.table(name)


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words as rows, with their block and number."""
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(unpacked(row["lengths"]), dtype=np.int32)
            bounds = np.append(np.zeros(1, np.int32), ends)
            number = np.cumsum(unpacked(row["steps"]), dtype=np.int32)
            words_ = pa.BinaryArray.from_buffers(
                pa.binary(), len(number), [None, pa.py_buffer(bounds), pa.py_buffer(row["words"])]
            )
            block = np.full(len(number), row["block"], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(number), words_], names=["block", "number", "word"]
            )


def _word_ids(staged: DataFrame, how: Settings) -> DataFrame:
    """Ids of every word of every block; equal words meet, and are encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = _encoder(how.ranks), (None, [])
        for batch in batches:
            if not len(batch):
                continue
            coded = batch.column(2).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            # The rows are sorted, so only the first word can go on from the last batch.
            ids = [
                last[1] if word == last[0] else encoder.encode_ordinary(word.decode())
                for word in distinct
            ]
            last = (distinct[-1], ids[-1])
            block, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.lexsort((number, block))
            to, first = np.unique(block[order], return_index=True)
            at = np.append(first, len(order))
            found = pa.array(ids, pa.list_(pa.int32())).take(coded.indices.take(pa.array(order)))
            ends, flat = found.offsets.to_numpy(), found.values.to_numpy()
            rows = [
                {
                    "block": int(b),
                    "steps": packed(np.diff(number[order[x:y]], prepend=0)),
                    "lengths": packed(np.diff(ends[x : y + 1])),
                    "ids": packed(flat[ends[x] : ends[y]]),
                }
                for b, x, y in zip(to, at[:-1].tolist(), at[1:].tolist())
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_ANSWERS)

    dealt = staged.select("block", "part", "steps", "lengths", "words").repartition("part")
    single = dealt.select("block", "steps", "lengths", "words").mapInArrow(
        _single, "block long, number int, word binary"
    )
    return single.sortWithinPartitions("word").mapInArrow(run, _ANSWERS_DDL)


def _assembled(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
    """The ids of the texts of a block, by position."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    number, length, held = [], [], []
    for batch in answers.to_batches():
        for _, steps, lengths, ids in zip(*(c.to_pylist() for c in batch.columns)):
            number.append(np.cumsum(unpacked(steps)))
            length.append(unpacked(lengths))
            held.append(unpacked(ids).astype(np.int32))
    none = [np.zeros(0, np.int32)]
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int32), *length]), dtype=np.int32)
    by_word = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held or none)))
    by_word = by_word.take(pa.array(np.argsort(np.concatenate(number or none))))
    del held, number, length, answers
    _give_back()
    out = []
    # One run of texts at a time is taken out of the block.
    for i in np.argsort(rows.column("row").to_numpy()).tolist():
        row = rows.slice(i, 1).to_pylist()[0]
        taken = by_word.take(pa.array(unpacked(row["positions"])))
        cuts = taken.offsets.to_numpy()[np.cumsum([0, *row["counts"]])]
        found = pa.ListArray.from_arrays(pa.array(cuts), taken.values)
        out.append(
            pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), found], schema=schema
            )
        )
    return pa.Table.from_batches(out, schema=schema)


def encode(
    docs: DataFrame, how: Settings, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id and ids, as ``array<int>``."""
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    staged = _in_blocks(chosen, how)
    texts = staged.filter(F.col("part").isNull()).select(
        "block", "row", "doc_ids", "counts", "positions"
    )
    answers = _word_ids(staged.filter(F.col("part").isNotNull()), how)
    both = texts.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(_assembled, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, how: Settings, ids: str = "ids") -> DataFrame:
    """Adds ``bytes``, what the ids stand for, to a frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(how.ranks)
        for whole in batches:
            counts = pc.fill_null(pc.list_value_length(whole.column(ids)), 0).to_numpy()
            for first, last in blocks(np.append(0, np.cumsum(counts)), BLOCK // 8):
                batch = whole.slice(first, last - first)
                flat = pc.fill_null(batch.column(ids).flatten(), len(table) - 1)
                known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table)))
                tokens = table.take(pc.if_else(known, flat, len(table) - 1))
                ends = np.frombuffer(tokens.buffers()[1], np.int64)
                bounds = ends[np.append(0, np.cumsum(counts[first:last]))]
                joined = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(batch), [None, pa.py_buffer(bounds), tokens.buffers()[2]]
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, joined.cast(pa.binary())],
                    names=[*batch.schema.names, "bytes"],
                )
            del whole
            _give_back()

    schema = encoded.drop("bytes").schema.add("bytes", "binary")
    return encoded.drop("bytes").mapInArrow(run, schema)
