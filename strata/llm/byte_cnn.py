"""Quality by a convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover all of it. Learned filters slide over
the embedded bytes of a chunk, and the strongest answer of each filter is kept. The mean
over the chunks goes through one linear layer to a single probability.

Filters and embedding are folded into one table per filter position, so a chunk is scored
by table reads. Learning needs only the position at which each filter was strongest, which
keeps the gradient small.

The network is fitted on a bounded sample of labelled texts (``Settings.sample_rows``, and
of each text a bounded number of chunks spread over it) and has a fixed size; every text is
scored whole.

Defined results: NULL and empty texts have no chunk and get the probability of the bias;
without labels of both kinds every score is the share of label 1 (0.5 without any);
repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.buffers import utf8
from strata.llm.labelled import sample


@dataclass(frozen=True)
class Settings:
    width: int = 6
    filters: int = 16
    embedding: int = 8
    chunk: int = 256
    step: int = 224
    sample_rows: int = 4000
    sample_max_bytes: int = 50_000
    chunks_per_text: int = 6
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``tables[j][byte]`` is what a byte at place j of a window adds to each filter."""

    tables: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    intercept: float


def _logit(rate: float) -> float:
    bound = min(max(rate, 1e-6), 1 - 1e-6)
    return float(np.log(bound / (1 - bound)))


def _starts(length: int, how: Settings) -> np.ndarray:
    """Starts of the chunks of a text; the last chunk may be short, none is left out."""
    if length == 0:
        return np.zeros(0, dtype=np.int64)
    n = 1 + max(0, -(-(length - how.chunk) // how.step))
    return np.arange(n, dtype=np.int64) * how.step


def _windows(text: bytes, start: int, how: Settings) -> np.ndarray:
    """A chunk as rows of windows, zero bytes after its end."""
    padded = np.zeros(how.chunk + how.width - 1, dtype=np.uint8)
    held = np.frombuffer(text[start : start + len(padded)], dtype=np.uint8)
    padded[: len(held)] = held
    return padded


def fit(labelled: pd.DataFrame, how: Settings = Settings()) -> Model:
    y = labelled["label"].to_numpy(dtype=np.float64) if len(labelled) else np.zeros(0)
    k, f, d = how.width, how.filters, how.embedding
    random = np.random.default_rng(how.seed)
    embedding = random.normal(0, 0.5, (256, d))
    filters = random.normal(0, (1 / (k * d)) ** 0.5, (k, d, f))
    params = {
        "e": embedding,
        "w": filters,
        "b": np.zeros(f),
        "v": random.normal(0, 0.1, f),
        "c": np.array([_logit(float(y.mean()) if len(y) else 0.5)]),
    }
    if len(y) and 0 < y.sum() < len(y):
        _learn([t.encode() for t in labelled["text"]], y, params, how, random)
    else:
        params["v"][:] = 0
    tables = np.einsum("bd,kdf->kbf", params["e"], params["w"]).astype(np.float32)
    return Model(
        tables, params["b"].astype(np.float32), params["v"], float(params["c"][0])
    )


def _learn(texts: list[bytes], y: np.ndarray, p: dict, how: Settings, random) -> None:
    """Adam over batches of texts; each text is a few chunks drawn anew every epoch."""
    m = {n: np.zeros_like(x) for n, x in p.items()}
    v = {n: np.zeros_like(x) for n, x in p.items()}
    k, step = how.width, 0
    # The rarer label weighs as much as the other.
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
    for epoch in range(how.epochs):
        rate = how.rate * (1 - epoch / how.epochs)
        order = random.permutation(len(texts))
        for first in range(0, len(order), how.batch):
            rows = order[first : first + how.batch]
            chunks, owner = [], []
            for i, r in enumerate(rows):
                starts = _starts(len(texts[r]), how)
                if len(starts) > how.chunks_per_text:
                    starts = random.choice(starts, how.chunks_per_text, replace=False)
                chunks += [_windows(texts[r], int(s), how) for s in starts]
                owner += [i] * len(starts)
            if not chunks:
                continue
            step += 1
            grads = _gradient(
                np.array(chunks), np.array(owner), y[rows], balance[rows], p, k
            )
            for n, g in grads.items():
                m[n] = 0.9 * m[n] + 0.1 * g
                v[n] = 0.999 * v[n] + 0.001 * g * g
                corrected = np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8
                p[n] -= rate * (m[n] / (1 - 0.9**step)) / corrected


def _gradient(
    chunks: np.ndarray, owner: np.ndarray, y: np.ndarray, w: np.ndarray, p: dict, k: int
) -> dict[str, np.ndarray]:
    n, f = len(chunks), len(p["b"])
    tables = np.einsum("bd,kdf->kbf", p["e"], p["w"]).astype(np.float32)
    length = chunks.shape[1] - k + 1
    z = tables[0][chunks[:, :length]]
    for j in range(1, k):
        z += tables[j][chunks[:, j : j + length]]
    best = z.argmax(axis=1)
    top = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0, :] + p["b"]
    active = top > 0
    pooled = np.where(active, top, 0)
    count = np.maximum(np.bincount(owner, minlength=len(y)), 1)
    mean = np.zeros((len(y), f))
    np.add.at(mean, owner, pooled)
    mean /= count[:, None]
    logit = mean @ p["v"] + p["c"][0]
    error = w * (1 / (1 + np.exp(-logit)) - y) / len(y)
    back = (error / count)[owner][:, None] * p["v"] * active
    table_grad = np.zeros((k, 256, f))
    column = np.broadcast_to(np.arange(f), (n, f))
    row = np.arange(n)[:, None]
    for j in range(k):
        np.add.at(table_grad[j], (chunks[row, best + j], column), back)
    return {
        "e": np.einsum("kbf,kdf->bd", table_grad, p["w"]),
        "w": np.einsum("bd,kbf->kdf", p["e"], table_grad) + 1e-5 * p["w"],
        "b": back.sum(axis=0),
        "v": mean.T @ error + 1e-5 * p["v"],
        "c": np.array([error.sum()]),
    }


#: Bytes whose filter answers are held at once.
PIECE = 1 << 17


def scores(
    data: np.ndarray, offsets: np.ndarray, model: Model, how: Settings = Settings()
) -> np.ndarray:
    """Probability of label 1 for each text of a buffer."""
    f, n = len(model.bias), len(offsets) - 1
    lengths = np.diff(offsets)
    per_text = np.where(
        lengths > 0,
        1 + np.maximum(0, -(-(lengths - how.chunk) // how.step)),
        0,
    )
    owner = np.repeat(np.arange(n), per_text)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    starts = offsets[:-1][owner] + order * how.step
    ends = offsets[1:][owner]
    total = np.zeros((n, f))
    at_once = max(1, PIECE // how.chunk)
    reach = np.arange(how.chunk + how.width - 1)
    for first in range(0, len(owner), at_once):
        part = slice(first, first + at_once)
        place = starts[part][:, None] + reach
        inside = place < ends[part][:, None]
        chunks = np.where(inside, data[np.minimum(place, len(data) - 1)], 0)
        z = model.tables[0][chunks[:, : how.chunk]]
        for j in range(1, how.width):
            z += model.tables[j][chunks[:, j : j + how.chunk]]
        top = np.maximum(z.max(axis=1) + model.bias, 0)
        np.add.at(total, owner[part], top)
    mean = total / np.maximum(per_text, 1)[:, None]
    logit = mean @ model.weight + model.intercept
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def score(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    how: Settings = Settings(),
) -> DataFrame:
    """One row per input row: doc_id and score. ``learn`` is a condition on doc_id."""
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(id).cast("long").alias("doc_id"), F.col(label))
    model = fit(
        sample(chosen, known, label, learn, how.sample_rows, how.sample_max_bytes), how
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(*utf8(batch.column(1)), shared.value, how)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())],
                names=["doc_id", "score"],
            )

    return chosen.mapInArrow(run, "doc_id long, score double")
