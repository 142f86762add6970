"""Token ids of documents in wavelet matrix files, in ascending order of their id.

Documents are dealt to ranges of ids and sorted within them; each task encodes its range
and closes a shard at the first document end after ``shard_tokens`` ids, so memory is
bounded by a shard and the longest document. A shard is one row of a Parquet table in the
shared folder: the file of its ids, and the ids and lengths of its documents.

Defined results: NULL and empty texts are the end id alone; rows that repeat an id come in
order of a hash of their text, each a document of its own; a NULL id comes first; an empty
table gives no shards; nothing is truncated.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.frames import staged
from strata.llm.wavelet import WaveletMatrix, build


@dataclass(frozen=True)
class Settings:
    """``words_apart``: the vocabulary drops white space and never joins across it."""

    vocabulary: str
    end_id: int = 2
    shard_tokens: int = 1 << 20
    words_apart: bool = True
    kept_words: int = 1_000_000


#: Letters, then marks: two pieces for a vocabulary that splits on what is no letter.
#: Only letters that no normal form changes, and no apostrophe, which may take letters.
_PLAIN = re.compile(
    r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)"
)
_SLICE = 1 << 20


class _Words(dict):
    """Ids of words met before; ``find`` gives those of a new one. Emptied when full."""

    def __init__(self, find: Callable[[str], bytes], most: int):
        super().__init__({"": b""})
        self.find, self.most = find, most

    def __missing__(self, word: str) -> bytes:
        found = self.find(word)
        if len(word) < 200:
            if len(self) > self.most:
                self.clear()
                self[""] = b""
            self[word] = found
        return found


class Encoder:
    """Ids of texts, with the ids of words that were met before kept.

    A word is what stands between spaces or newlines. Words of plain letters and marks go
    to the model piece by piece, all others through the whole tokenizer.
    """

    def __init__(self, how: Settings):
        from tokenizers import Tokenizer, pre_tokenizers

        self.how = how
        self.tokenizer = Tokenizer.from_file(how.vocabulary)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.code = "H" if size <= 1 << 16 else "I"
        self.dtype = np.dtype(f"u{array(self.code).itemsize}")
        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = _Words(self._piece, how.kept_words)
        self.words = _Words(self._word, how.kept_words // 2)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join(p for p, _ in self.level.pre_tokenize_str(piece))
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.pieces[word.lower()]
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(word)
        return self.pieces[plain[1].lower()] + self.pieces[plain[2]]

    def encode(self, text: str) -> np.ndarray:
        if not self.how.words_apart:
            return np.frombuffer(self._whole(text), dtype=self.dtype)
        out = []
        start = 0
        text = text.replace("\n", " ")
        find = self.words.__getitem__
        while start < len(text):
            end = start + _SLICE
            if end < len(text):
                end = text.find(" ", end)
                end = len(text) if end < 0 else end
            out.append(b"".join(map(find, text[start:end].split(" "))))
            start = end
        return np.frombuffer(b"".join(out), dtype=self.dtype)


_ENCODERS: dict[Settings, Encoder] = {}


def _encoder(how: Settings) -> Encoder:
    """One encoder for each worker process, so that its words are kept between tasks."""
    if how not in _ENCODERS:
        _ENCODERS[how] = Encoder(how)
    return _ENCODERS[how]


_SHARD = pa.schema(
    [
        ("range", pa.int32()),
        ("shard", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("tokens", pa.int64()),
        ("file", pa.binary()),
    ]
)


def write_shards(
    docs: DataFrame, how: Settings, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode a frame; the shards as written: range, shard, doc_ids, lengths, tokens, file."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(how)
        end = np.array([how.end_id], dtype=encoder.dtype)
        ids: list[int | None] = []
        texts: list[np.ndarray] = []
        held = shard = place = 0

        def close() -> pa.RecordBatch:
            sequence = np.concatenate([x for t in texts for x in (t, end)])
            row = {
                "range": place,
                "shard": shard,
                "doc_ids": ids,
                "lengths": [len(t) + 1 for t in texts],
                "tokens": len(sequence),
                "file": build(sequence),
            }
            return pa.RecordBatch.from_pylist([row], schema=_SHARD)

        for batch in batches:
            for i, value, at in zip(*(batch.column(k) for k in range(3))):
                place = at.as_py()
                ids.append(i.as_py())
                texts.append(encoder.encode(value.as_py() or ""))
                held += len(texts[-1]) + 1
                if held >= how.shard_tokens:
                    yield close()
                    ids, texts, held, shard = [], [], 0, shard + 1
        if ids:
            yield close()

    dealt = (
        docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(ranges, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text", F.spark_partition_id().alias("range"))
    )
    shards = dealt.mapInArrow(
        run,
        "range int, shard int, doc_ids array<long>, lengths array<long>, tokens long, "
        "file binary",
    )
    return staged(shards, "token-shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Offsets are summed per range and
    over the ranges, of which there are as many as tasks; the files are not shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequence = WaveletMatrix(row["file"]).decode().astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crc = [
                    zlib.crc32(sequence[a:b]) for a, b in zip(starts.tolist(), ends.tolist())
                ]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["range"]] * n, pa.int32()),
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["range", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    read = shards.select("range", "shard", "doc_ids", "lengths", "file").mapInArrow(
        run,
        "range int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long",
    )
    sizes = shards.select("range", "shard", "tokens")
    before = Window.partitionBy("range").orderBy("shard")
    in_range = sizes.withColumn("before", F.sum("tokens").over(before) - F.col("tokens"))
    totals = sizes.groupBy("range").agg(F.sum("tokens").alias("total"))
    # One row per task of the write; the running sum over them fits one task.
    earlier = totals.select(
        "range",
        (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("earlier"),
    )
    offsets = staged(
        in_range.join(earlier, "range").select(
            "range", "shard", (F.col("before") + F.col("earlier")).alias("offset")
        ),
        "shard-offsets",
    )
    return read.join(offsets, ["range", "shard"]).select(
        "doc_id",
        (F.col("offset") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
