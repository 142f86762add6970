"""Toxicity by a linear classifier on character n-grams scaled by log-count ratios.

A text is the set of its character n-grams of several lengths, hashed into a table. Each
feature is scaled by its naive Bayes log-count ratio between toxic and other texts, and a
logistic regression is fitted on the scaled features. Features whose ratio could be chance
are left out, so a long text is not drowned in the noise of its ordinary n-grams.

The model is fitted on a bounded sample of labelled texts (``Settings.sample_rows``) and
has a fixed size; every text is scored whole.

Defined results: NULL and empty texts have no features and get the score of the intercept;
without labels of both kinds every score is the share of toxic labels (0 without any);
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

from strata.llm.labelled import sample


@dataclass(frozen=True)
class Settings:
    lengths: tuple[int, ...] = (3, 4, 5, 6)
    table_bits: int = 20
    sample_rows: int = 6000
    sample_max_bytes: int = 50_000
    min_texts: int = 4
    min_deviations: float = 4.0
    smoothing: float = 1.0
    penalty: float = 1e-3
    steps: int = 300


@dataclass(frozen=True)
class Model:
    """``feature`` maps a hashed n-gram to a feature, -1 to none."""

    feature: np.ndarray
    weight: np.ndarray
    intercept: float


_BASE = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)
#: Characters worked on at once; n-grams that cross a cut are in both pieces.
PIECE = 1 << 18


def _codes(text: str) -> np.ndarray:
    """Code points with A-Z in lower case."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    upper = (codes >= 65) & (codes <= 90)
    return codes + upper.astype(np.uint32) * np.uint32(32)


def _grams(codes: np.ndarray, how: Settings) -> Iterator[np.ndarray]:
    """Hash of the n-gram at each position, for each length."""
    rolled = codes.copy()
    shift = np.uint32(32 - how.table_bits)
    for n in range(1, max(how.lengths) + 1):
        if n > 1:
            if len(codes) < n:
                return
            rolled = rolled[:-1] * _BASE + codes[n - 1 :]
        if n in how.lengths:
            yield (rolled * _SPREAD + np.uint32(n) * _BASE) * _SPREAD >> shift


def _pieces(text: str, how: Settings) -> Iterator[np.ndarray]:
    codes = _codes(text)
    overlap = max(how.lengths) - 1
    for start in range(0, max(len(codes) - overlap, 1), PIECE):
        yield codes[start : start + PIECE + overlap]


def _features(text: str, how: Settings) -> np.ndarray:
    found = [np.unique(g) for p in _pieces(text, how) for g in _grams(p, how)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def fit(labelled: pd.DataFrame, how: Settings = Settings()) -> Model:
    y = labelled["label"].to_numpy(dtype=np.float64) if len(labelled) else np.zeros(0)
    size = 1 << how.table_bits
    none = np.full(size, -1, dtype=np.int32)
    positives = int(y.sum())
    if positives in (0, len(y)):
        rate = float(y.mean()) if len(y) else 0.0
        bound = min(max(rate, 1e-9), 1 - 1e-9)
        return Model(none, np.zeros(1, np.float32), float(np.log(bound / (1 - bound))))
    sets = [_features(t, how) for t in labelled["text"]]
    has = np.zeros((2, size))
    for s, label in zip(sets, y):
        has[int(label), s] += 1
    texts = has.sum(axis=0)
    share = positives / len(y)
    # Deviations of the toxic count from what chance gives at the overall share.
    expected = texts * share
    deviations = np.abs(has[1] - expected) / np.sqrt(expected * (1 - share) + 1e-9)
    chosen = np.flatnonzero(
        (texts >= how.min_texts) & (deviations >= how.min_deviations)
    )
    feature = none.copy()
    feature[chosen] = np.arange(len(chosen), dtype=np.int32)
    p = how.smoothing + has[1, chosen]
    q = how.smoothing + has[0, chosen]
    ratio = np.log((p / (positives + 2 * how.smoothing)) / (
        q / (len(y) - positives + 2 * how.smoothing)
    ))
    rows, columns = [], []
    for i, s in enumerate(sets):
        mine = feature[s]
        mine = mine[mine >= 0]
        rows.append(np.full(len(mine), i))
        columns.append(mine)
    row, column = np.concatenate(rows), np.concatenate(columns)
    weight, intercept = _logistic(row, column, ratio, y, how)
    return Model(feature, (weight * ratio).astype(np.float32), intercept)


def _logistic(
    row: np.ndarray, column: np.ndarray, ratio: np.ndarray, y: np.ndarray, how: Settings
) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features by adaptive gradient steps."""
    value, n = ratio[column], len(y)
    theta = np.zeros(len(ratio) + 1)
    theta[-1] = np.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, how.steps + 1):
        z = np.bincount(row, theta[column] * value, minlength=n) + theta[-1]
        error = (1 / (1 + np.exp(-z)) - y) / n
        gradient = np.bincount(column, error[row] * value, minlength=len(ratio))
        gradient = np.append(gradient + how.penalty * theta[:-1], error.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        theta -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score_text(text: str | None, model: Model, how: Settings = Settings()) -> float:
    found = []
    for piece in _pieces(text or "", how):
        for grams in _grams(piece, how):
            mine = model.feature[grams]
            found.append(mine[mine >= 0])
    held = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)
    z = float(model.weight[held].sum(dtype=np.float64)) + model.intercept
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def score(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    how: Settings = Settings(),
) -> DataFrame:
    """One row per input row: doc_id and score. ``learn`` is a condition on doc_id."""
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col(id).cast("long").alias("doc_id"), F.col(label))
    model = fit(
        sample(chosen, known, label, learn, how.sample_rows, how.sample_max_bytes), how
    )
    # The table has a fixed number of entries, whatever the texts are.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_text(t.as_py(), shared.value, how) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())],
                names=["doc_id", "score"],
            )

    return chosen.mapInArrow(run, "doc_id long, score double")
