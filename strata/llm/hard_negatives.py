"""Hard negatives by an inverted multi-index: exact searches that stop early.

Vectors are scaled to whole numbers, so that scores are exact. Each half of the vector
space has a codebook, fitted on a bounded sample; a vector's cell is the pair of its
nearest centroids, and every vector is in the index. For a query the score with any vector
of a cell is at most the sum over both halves of ``q . centroid + |q| * radius``, the
radius being that of the half's cluster over all vectors. A heap over the two sorted lists
of half bounds (the multi-sequence walk) gives the cells in descending order of that sum.

A search visits cells in this order, in rounds that each double the number of cells. A
round deals queries to cells, multiplies blocks of members and queries, and keeps what may
still be among the first of a window of scores. A window is certified, and the query stops
when all of its are, once it has its rows and the last of them scores above the bound of
the next cell, or the window lies above that bound. Where bounds prune nothing, as for
random vectors, all cells are visited in blocks; the result is exact either way.

First the positives are searched, in one window without limits; they give the windows of
the negatives.

Equal vectors of one label are one entry with their first ids, one more than the positives
of an anchor: no result can hold further copies of an entry. Anchors that are equal are one
query. Cells are split in parts by their size and queries of a cell in slices by their
number, so a block is bounded however many vectors are alike; codebooks and cell sizes are
all that the driver holds.

Defined results: rows with a NULL label or vector, or with a component that is NULL, not
finite or at least 2^28 in size after scaling, take no part; shorter vectors are read as
filled with zeros; rows without id are no anchors and come last among equal scores; rows
that repeat an id are rows of their own, and a repeated anchor gives its rows repeatedly;
an anchor without another row of its label, and a positive without a row in its window,
give no rows; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.frames import staged


@dataclass(frozen=True)
class Settings:
    """Windows are in percent of the positive's score.

    Codebooks have ``centroids`` entries a half at most, fewer while cells would hold less
    than ``cell_rows`` vectors; they are fitted on ``sample_rows`` vectors at most and
    ``sample_bytes`` at most, those with the smallest hash.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low_percent: int = 50
    high_percent: int = 95
    centroids: int = 64
    cell_rows: int = 512
    sample_rows: int = 20_000
    sample_bytes: int = 64 << 20
    fit_rounds: int = 8
    first_cells: int = 16
    block_rows: int = 4096


#: Scaled components stay below this, so that sums of products fit a long.
_LARGEST = 1 << 28
_LEAST_SCORE, _MOST_SCORE = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Codebooks:
    """Centroids and radii of both halves; cells hold vectors if their size is not 0."""

    centroids: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.centroids[0].shape[1]
        return vectors[:, :at].astype(float), vectors[:, at:].astype(float)

    def bounds(self, queries: np.ndarray) -> list[np.ndarray]:
        """Upper bounds of the scores of each half with the vectors of each cluster."""
        found = []
        for half, centroids, radius in zip(
            self.halves(queries), self.centroids, self.radii
        ):
            norm = np.linalg.norm(half, axis=1)[:, None]
            size = norm * (np.linalg.norm(centroids, axis=1) + radius)
            # The last term is far above the rounding of the sums.
            found.append(half @ centroids.T + norm * radius + 1e-9 * size + 0.5)
        return found

    def walk(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, float]]:
        """Cells that hold vectors by descending sum of their half bounds."""
        a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        x, y = first[a].tolist(), second[b].tolist()
        heap = [(-(x[0] + y[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(y):
                heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(x):
                heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
            cell = int(a[i]) * len(y) + int(b[j])
            if self.sizes[cell]:
                yield cell, -bound


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Nearest centroid of each vector, in blocks."""
    lengths = (centroids**2).sum(axis=1)
    step = max(1, (1 << 22) // len(centroids))
    return np.concatenate(
        [np.zeros(0, np.int64)]
        + [
            np.argmin(lengths - 2 * (vectors[i : i + step] @ centroids.T), axis=1)
            for i in range(0, len(vectors), step)
        ]
    )


def fit(vectors: np.ndarray, entries: int, rounds: int) -> Codebooks:
    """Centroids of each half by Lloyd's method, from the first distinct half vectors."""
    at = vectors.shape[1] // 2
    books = []
    for half in (vectors[:, :at].astype(float), vectors[:, at:].astype(float)):
        _, first = np.unique(half, axis=0, return_index=True)
        centroids = half[np.sort(first)[:entries]]
        for _ in range(rounds):
            near = _nearest(half, centroids)
            for i in range(len(centroids)):
                mine = half[near == i]
                if len(mine):
                    centroids[i] = mine.mean(axis=0)
        books.append(centroids)
    first, second = (len(b) for b in books)
    unknown = np.zeros(first), np.zeros(second)
    return Codebooks((books[0], books[1]), unknown, np.zeros(first * second, np.int64))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def scores(members: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of rows, exactly; in floats while their sums of products are exact."""
    if not members.size or not queries.size:
        return np.zeros((len(members), len(queries)), dtype=np.int64)
    most = float(np.abs(members).max()) * float(np.abs(queries).max())
    if most * members.shape[1] < 2**53:
        return (members.astype(float) @ queries.astype(float).T).astype(np.int64)
    return members.astype(np.int64) @ queries.astype(np.int64).T


def _entries(rows: DataFrame, how: Settings) -> DataFrame:
    """Distinct vectors of a label with their first ids."""
    order = Window.partitionBy("key").orderBy(F.asc_nulls_last("vec_id"))
    first = rows.withColumn("at", F.row_number().over(order)).filter(
        F.col("at") <= how.positives + 1
    )
    return (
        first.withColumn("vector", F.when(F.col("at") == 1, F.col("vector")))
        .groupBy("key", "label")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", "vec_id"))).alias("ids"),
            F.flatten(F.collect_list("vector")).alias("vector"),
        )
        .withColumn("ids", F.col("ids.vec_id"))
    )


def _assigned(entries: DataFrame, books: Codebooks) -> DataFrame:
    """Adds the cell and the distances to both centroids."""
    n = len(books.centroids[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), len(batch))
            near, far = [], []
            for half, centroids in zip(books.halves(vectors), books.centroids):
                near.append(_nearest(half, centroids))
                far.append(np.linalg.norm(half - centroids[near[-1]], axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near[0] * n + near[1]), *map(pa.array, far)],
                names=[*batch.schema.names, "cell", "far1", "far2"],
            )

    fields = "cell long, far1 double, far2 double"
    return entries.mapInArrow(
        run, f"key binary, label long, ids array<long>, vector array<int>, {fields}"
    )


def _index(entries: DataFrame, how: Settings) -> tuple[DataFrame, Codebooks]:
    """All entries with their cell, and the codebooks with radii over all of them."""
    n, width = entries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    rows = max(1, min(how.sample_rows, how.sample_bytes // (8 * max(1, width))))
    sample = entries.select("key", "vector").orderBy("key").limit(rows).toPandas()
    per_half = max(1, min(how.centroids, round((n / how.cell_rows) ** 0.5)))
    vectors = np.array(sample["vector"].tolist(), dtype=np.int64).reshape(len(sample), -1)
    books = fit(vectors, per_half, how.fit_rounds)
    index = staged(_assigned(entries, books), "cells")
    first, second = (len(c) for c in books.centroids)
    held = index.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("far1").alias("a"), F.max("far2").alias("b")
    )
    sizes = np.zeros(first * second, dtype=np.int64)
    radii = np.zeros(first), np.zeros(second)
    # One row a cell, of which there are as many as the codebooks allow.
    for cell, size, a, b in held.collect():
        sizes[cell] = size
        radii[0][cell // second] = max(radii[0][cell // second], a)
        radii[1][cell % second] = max(radii[1][cell % second], b)
    return index, Codebooks(books.centroids, radii, sizes)


_WINDOWS = "windows array<struct<pos:long,low:long,high:long>>"


def _visits(queries: DataFrame, books: Codebooks, done: int, step: int) -> DataFrame:
    """The next cells of each query, and the bound of the one after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), len(batch))
            at, cells, after = [], [], []
            for i, (a, b) in enumerate(zip(*books.bounds(vectors))):
                seen, bound = 0, None
                mine = []
                for cell, bound_ in books.walk(a, b):
                    if seen == done + step:
                        bound = bound_
                        break
                    if seen >= done:
                        mine.append(cell)
                    seen += 1
                at += [i] * len(mine)
                cells += mine
                after += [bound] * len(mine)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(cells, pa.int64()), pa.array(after, pa.float64())],
                names=[*batch.schema.names, "cell", "after"],
            )

    return queries.mapInArrow(
        run,
        f"key binary, label long, vector array<int>, {_WINDOWS}, cell long, after double",
    )


_FOUND = "key binary, pos long, score long, vec_id long"
_FOUND_ARROW = pa.schema(
    [("key", pa.binary()), ("pos", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())]
)


def _scored(same_label: bool, keep: int):
    """The first ``keep`` rows of a block for each window of each query."""

    def run(key: tuple, members: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(members) or not len(queries):
            return _FOUND_ARROW.empty_table()
        vectors = _matrix(members.column("vector"), len(members))
        labels = members.column("label").to_numpy()
        ids = members.column("ids").combine_chunks()
        id_ends = ids.offsets.to_numpy()
        id_ends = id_ends - id_ends[0]
        id_values = ids.flatten()
        order_of = id_values.fill_null(np.iinfo(np.int64).max).to_numpy()
        windows = queries.column("windows").combine_chunks()
        ends = windows.offsets.to_numpy() - windows.offsets.to_numpy()[0]
        pos, low, high = (windows.flatten().field(i).to_numpy() for i in range(3))
        wanted = _matrix(queries.column("vector"), len(queries))
        query_labels = queries.column("label").to_numpy()
        out = []
        step = max(1, (1 << 20) // len(members))
        for first in range(0, len(queries), step):
            last = min(first + step, len(queries))
            score = scores(vectors, wanted[first:last])
            alike = labels[:, None] == query_labels[None, first:last]
            score[alike != same_label] = _LEAST_SCORE - 1
            of = np.repeat(np.arange(first, last), np.diff(ends[first : last + 1]))
            for w in range(0, len(of), step):
                window = np.arange(w, min(w + step, len(of))) + ends[first]
                query = of[w : w + step]
                held = score[:, query - first]
                held = np.where(
                    (held >= low[window]) & (held <= high[window]), held, _LEAST_SCORE - 1
                )
                if len(held) > keep:
                    least = np.partition(held, len(held) - keep, axis=0)[len(held) - keep]
                else:
                    least = np.full(len(window), _LEAST_SCORE)
                column, row = np.nonzero((held >= np.maximum(least, _LEAST_SCORE)).T)
                # An entry stands for its copies.
                n = np.diff(id_ends)[row]
                column, row = np.repeat(column, n), np.repeat(row, n)
                place = id_ends[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                value = held[row, column]
                order = np.lexsort((order_of[place], -value, column))
                starts = np.searchsorted(column[order], np.arange(len(window)))
                among = np.arange(len(order)) - starts[column[order]]
                order = order[among < keep]
                out.append(
                    pa.table(
                        [
                            queries.column("key").take(pa.array(query[column[order]])),
                            pa.array(pos[window[column[order]]]),
                            pa.array(value[order]),
                            id_values.take(pa.array(place[order])),
                        ],
                        schema=_FOUND_ARROW,
                    )
                )
        return pa.concat_tables(out)

    return run


def _first(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("key", "pos").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id")
    )
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= keep)


def _search(
    index: DataFrame,
    books: Codebooks,
    queries: DataFrame,
    windows: DataFrame,
    same_label: bool,
    keep: int,
    how: Settings,
) -> DataFrame:
    """The first ``keep`` rows of every window: key, pos, score, vec_id, rank.

    ``windows`` has key, pos, low and high; ``pos`` tells the windows of a query apart.
    """
    spark = index.sparkSession
    best = _first(spark.createDataFrame([], _FOUND), keep)
    done, step = 0, how.first_cells
    while True:
        limits = windows.groupBy("key").agg(
            F.collect_list(F.struct("pos", "low", "high")).alias("windows")
        )
        visits = staged(
            _visits(
                queries.join(limits, "key").select("key", "label", "vector", "windows"),
                books,
                done,
                step,
            ),
            "visits",
        )
        # One row a cell.
        asked = visits.groupBy("cell").count().collect()
        if not asked:
            return best
        dealt = F.broadcast(
            spark.createDataFrame(
                [
                    (c, int(books.sizes[c] // how.block_rows + 1), n // how.block_rows + 1)
                    for c, n in asked
                ],
                "cell long, parts int, slices int",
            )
        )
        part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
        slice_ = F.pmod(F.xxhash64("key", F.lit(1)), F.col("slices")).cast("int")
        members = (
            index.select("cell", "key", "label", "ids", "vector")
            .join(dealt, "cell")
            .withColumn("part", part)
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            .drop("parts", "slices")
        )
        asking = (
            visits.drop("after")
            .join(dealt, "cell")
            .withColumn("slice", slice_)
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .drop("parts", "slices")
        )
        found = (
            members.groupBy("cell", "part", "slice")
            .cogroup(asking.groupBy("cell", "part", "slice"))
            .applyInArrow(_scored(same_label, keep), _FOUND)
        )
        best = staged(_first(best.drop("rank").unionByName(found), keep), "best")
        after = visits.groupBy("key").agg(F.first("after").alias("after"))
        state = best.groupBy("key", "pos").agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("least")
        )
        full = F.coalesce(F.col("n"), F.lit(0)) >= keep
        certified = (
            F.col("after").isNull()
            | (F.col("low") > F.col("after"))
            | (full & (F.col("least") > F.col("after")))
        )
        windows = staged(
            windows.join(after, "key")
            .join(state, ["key", "pos"], "left")
            .filter(~certified)
            .select(
                "key",
                "pos",
                F.when(full, F.greatest("low", "least")).otherwise(F.col("low")).alias("low"),
                "high",
            ),
            "windows",
        )
        done, step = done + step, 2 * step


def _prepared(
    vectors: DataFrame, anchor: Column, id: str, vector: str, label: Column, how: Settings
) -> DataFrame:
    """Rows that take part, with whole components of equal number and the entry's key."""
    chosen = vectors.select(
        F.col(id).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(anchor & F.col(id).isNotNull(), F.lit(False)).alias("anchor"),
    )
    limit = float(_LARGEST) / how.scale
    # NaN is above every number.
    usable = F.forall("vector", lambda x: F.coalesce(F.abs(x) < limit, F.lit(False)))
    whole = F.transform("vector", lambda x: F.floor(x * how.scale).cast("int"))
    rows = chosen.filter(F.col("label").isNotNull() & usable).withColumn("vector", whole)
    rows = staged(rows, "vectors")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    filled = F.concat(
        "vector", F.array_repeat(F.lit(0), F.lit(width) - F.size("vector"))
    )
    text = F.concat_ws(",", F.col("label"), F.col("vector").cast("array<string>"))
    return rows.withColumn("vector", filled).withColumn("key", F.unhex(F.md5(text)))


def mine(
    vectors: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    how: Settings = Settings(),
) -> DataFrame:
    """Hard negatives of the rows for which ``anchor`` holds.

    Rows: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = _prepared(vectors, anchor, id, vector, label, how)
    result = (
        "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long"
    )
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], result)
    index, books = _index(staged(_entries(rows, how), "entries"), how)
    anchors = rows.filter("anchor").select("vec_id", "key")
    queries = staged(
        index.join(anchors.select("key").distinct(), "key", "left_semi").select(
            "key", "label", "vector"
        ),
        "queries",
    )
    everything = queries.select(
        "key",
        F.lit(0).cast("long").alias("pos"),
        F.lit(_LEAST_SCORE).alias("low"),
        F.lit(_MOST_SCORE).alias("high"),
    )
    positives = _search(index, books, queries, everything, True, how.positives + 1, how)
    score = F.col("score")
    # Decimals, since a percentage of a score can leave the range of a long.
    exact = score.cast("decimal(20,0)")
    low = F.ceil(exact * how.low_percent / 100)
    high = F.floor(exact * how.high_percent / 100)
    windows = staged(
        positives.select(
            "key",
            score.alias("pos"),
            low.cast("long").alias("low"),
            high.cast("long").alias("high"),
        )
        .filter(F.col("low") <= F.col("high"))
        .distinct(),
        "windows",
    )
    negatives = _search(index, books, queries, windows, False, how.negatives, how)
    listed = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score")))
    found = (
        positives.groupBy("key")
        .agg(listed.alias("positives"))
        .join(
            negatives.groupBy("key", "pos")
            .agg(listed.alias("rows"))
            .groupBy("key")
            .agg(F.collect_list(F.struct("pos", "rows")).alias("negatives")),
            "key",
        )
        .join(queries.select("key", _squared("vector").alias("own")), "key")
    )
    each = anchors.join(found, "key")
    # The anchor itself is one of the rows with its id and its own score.
    itself = F.filter(
        "positives", lambda x: x["vec_id"].eqNullSafe(F.col("vec_id")) & (x["score"] == F.col("own"))
    )
    without = F.filter(
        "positives",
        lambda x: F.col("itself").isNull() | (x["rank"] != F.col("itself")),
    )
    return (
        each.withColumn("itself", F.get(itself, F.lit(0))["rank"])
        .select(
            F.col("vec_id").alias("anchor_id"),
            F.explode(F.slice(without, 1, how.positives)).alias("p"),
            "negatives",
        )
        .withColumn("n", F.filter("negatives", lambda x: x["pos"] == F.col("p.score")))
        .select("anchor_id", "p", F.explode(F.get("n", F.lit(0))["rows"]).alias("n"))
        .select(
            "anchor_id",
            F.col("p.vec_id").alias("positive_id"),
            F.col("n.rank").cast("int").alias("rank"),
            F.col("n.vec_id").alias("negative_id"),
            F.col("p.score").alias("positive_score"),
            F.col("n.score").alias("negative_score"),
        )
    )


def _squared(vector: str) -> Column:
    return F.aggregate(
        vector, F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long")
    )
