"""Mixing sources to target weights by entropy balancing.

Every source has a target number of words. The rates at which documents are taken are the
ones nearest to 1 in relative entropy, weighted by words, that meet the targets:
``exp(multiplier of the source + sum of tilt * feature)``, held at the highest rate.
The multipliers solve the convex dual by Newton's method; each iteration is one
distributed aggregate over the sizes, with one row per source as its result. Optional
features have a target for their mean over the words taken.

Rates are then rounded to whole copies. Within a bounded hash group of a source, from
long documents to short ones, each document passes on what its copies are short of or
over, so that a group ends within a short document of its share. Rows that are told apart
by nothing are rounded one by one all the same: their number is known, so it is computed
how many of them get one copy more.

What the driver holds is one row per source: the dual has one multiplier for each, and a
mix with more sources than fit a list is not one this method is for.

Defined results: NULL and empty texts have size 0 and are taken 0 words; a source whose
documents are all empty has target 0; of equal rows some may get one copy more than
the others; ties in size are taken in the order of a hash of the row; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.frames import WORD, staged


@dataclass(frozen=True)
class Mix:
    """Weights are dealt to the sources in code point order, NULL last, repeating."""

    weights: Sequence[float] = (3, 1, 2)
    total_percent: int = 150
    max_rate: int = 2
    max_iterations: int = 60
    tolerance: float = 1e-9
    group_rows: int = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: Mapping[str | None, int], mix: Mix) -> dict[str | None, float]:
    """Words to take from each source; what a full source can't take goes to the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    left = sum(sizes.values()) * mix.total_percent / 100
    most = {s: float(mix.max_rate * sizes[s]) for s in names}
    target: dict[str | None, float] = {}
    rest = names
    while rest:
        total = sum(weight[s] for s in rest)
        share = {s: left * weight[s] / total for s in rest}
        full = [s for s in rest if share[s] > most[s]]
        if not full:
            return target | share
        target |= {s: most[s] for s in full}
        left -= sum(most[s] for s in full)
        rest = [s for s in rest if s not in target]
    return target


def _by_source(df: DataFrame, values: DataFrame) -> DataFrame:
    """Join one row per source, NULL to NULL; Spark broadcasts it while it is small."""
    same = df["source"].eqNullSafe(values["source"])
    return df.join(values, same, "left").drop(values["source"])


def _local(df: DataFrame, rows: list[tuple], columns: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, f"source string, {columns}")


def solve(
    units: DataFrame,
    sizes: Mapping[str | None, int],
    targets: Mapping[str | None, float],
    mix: Mix,
    features: Mapping[str, float] | None = None,
) -> tuple[dict[str | None, float], np.ndarray]:
    """Multipliers of the sources and tilts of the features.

    The gradient and the Hessian of the dual are sums over documents, taken per source:
    words at the present rates, and of those below the highest rate also their products
    with the features. Sources meet only through the features, so the Newton system is
    solved by eliminating the sources first.
    """
    names = [s for s in sizes if sizes[s] > 0]
    full = {s for s in names if targets[s] >= mix.max_rate * sizes[s]}
    multiplier = {s: 0.0 for s in names}
    columns = list(features or {})
    tilt = np.zeros(len(columns))
    for s in full:
        # The limit of the dual: every document of the source at the highest rate.
        multiplier[s] = 700.0
    total = sum(targets.values())
    wanted = np.array([(features or {})[c] * total for c in columns])
    for _ in range(mix.max_iterations):
        got = _sums(units, multiplier, tilt, columns, mix)
        free = [s for s in names if s not in full]
        gap = np.array([got[s]["words"] - targets[s] for s in free])
        # Where most words are held at the highest rate the dual is nearly straight; the
        # slope of the whole then damps the step.
        slope = np.array(
            [
                got[s]["free"] if 2 * got[s]["free"] > got[s]["words"] else got[s]["words"]
                for s in free
            ]
        )
        gap_f = sum((got[s]["x"] for s in names), np.zeros(len(columns))) - wanted
        scale = [max(1.0, targets[s]) for s in free]
        if all(abs(g) <= mix.tolerance * t for g, t in zip(gap, scale)) and np.all(
            np.abs(gap_f) <= mix.tolerance * np.maximum(1.0, np.abs(wanted))
        ):
            break
        cross = np.array([got[s]["free_x"] for s in free]).reshape(len(free), -1)
        if columns:
            curve = sum(got[s]["free_xx"] for s in names)
            reduced = curve - cross.T @ (cross / slope[:, None])
            step_f = np.linalg.lstsq(
                reduced, gap_f - cross.T @ (gap / slope), rcond=None
            )[0]
            tilt = tilt - np.clip(step_f, -1, 1)
            gap = gap - cross @ np.clip(step_f, -1, 1)
        for s, step in zip(free, gap / slope):
            multiplier[s] -= float(np.clip(step, -1, 1))
    # Sums of floats depend on their order in the last digits; rounded, reruns agree.
    return {s: round(multiplier.get(s, 0.0), 7) for s in sizes}, np.round(tilt, 7)


def _rate(columns: Sequence[str], tilt: Sequence[float], mix: Mix) -> Column:
    terms = [F.col(c) * F.lit(float(t)) for c, t in zip(columns, tilt)]
    exponent = reduce(lambda a, b: a + b, terms, F.col("multiplier"))
    return F.least(F.exp(exponent), F.lit(float(mix.max_rate)))


def _sums(
    units: DataFrame,
    multiplier: Mapping[str | None, float],
    tilt: np.ndarray,
    columns: Sequence[str],
    mix: Mix,
) -> dict[str | None, dict]:
    n = len(columns)
    words = F.col("size") * F.col("rate")
    free = F.when(F.col("rate") < mix.max_rate, words).otherwise(F.lit(0.0))
    sums = [F.sum(words).alias("words"), F.sum(free).alias("free")]
    sums += [F.sum(words * F.col(c)).alias(f"x{i}") for i, c in enumerate(columns)]
    sums += [F.sum(free * F.col(c)).alias(f"f{i}") for i, c in enumerate(columns)]
    sums += [
        F.sum(free * F.col(a) * F.col(b)).alias(f"f{i}_{j}")
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    rated = _by_source(
        units, _local(units, list(multiplier.items()), "multiplier double")
    ).filter(F.col("multiplier").isNotNull())
    rows = (
        rated.withColumn("rate", _rate(columns, tilt, mix))
        .groupBy("source")
        .agg(*sums)
        .collect()
    )
    return {
        r["source"]: {
            "words": r["words"],
            "free": r["free"],
            "x": np.array([r[f"x{i}"] for i in range(n)]),
            "free_x": np.array([r[f"f{i}"] for i in range(n)]),
            "free_xx": np.array(
                [[r[f"f{i}_{j}"] for j in range(n)] for i in range(n)]
            ).reshape(n, n),
        }
        for r in rows
    }


def _round_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for one group, so that its words stay near the sum of its shares."""
    rows = rows.sort_values(["doc_size", "tie"], ascending=[False, True], kind="stable")
    copies, more, over = [], [], 0.0
    for words, number, rate in zip(rows["doc_size"], rows["rows"], rows["rate"]):
        low = int(np.floor(rate + 1e-9))
        want = number * rate * words - over
        up = 0
        if words and rate - low > 1e-9:
            # One row after the other, each up when it is short by more than half of it.
            up = int(np.clip(np.ceil(want / words - number * low - 0.5), 0, number))
        copies.append(low)
        more.append(up)
        over = (number * low + up) * words - want
    rounded = rows.assign(
        copies=np.array(copies, dtype="int32"), more=np.array(more, dtype="int64")
    )
    return rounded[_COPIES.names]


_COPIES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("mark", T.LongType()),
        T.StructField("doc_size", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("rate", T.DoubleType()),
        T.StructField("copies", T.IntegerType()),
        T.StructField("more", T.LongType()),
    ]
)


def copies(
    sized: DataFrame, mix: Mix = Mix(), features: Mapping[str, float] | None = None
) -> DataFrame:
    """Copies for each distinct ``(doc_id, source, size)`` of a frame of these columns.

    A column ``mark`` tells rows apart further. ``features`` names further numeric columns
    and the mean that each shall have over the words taken. ``rows`` counts the input rows
    a result row stands for: each of them is taken ``copies`` times, and ``more`` of them
    once more.
    """
    columns = list(features or {})
    if "mark" not in sized.columns:
        sized = sized.withColumn("mark", F.lit(0).cast("long"))
    units = staged(
        sized.groupBy("doc_id", "source", "mark", F.col("size").alias("doc_size"))
        .agg(F.count(F.lit(1)).alias("rows"), *[F.max(c).alias(c) for c in columns])
        .withColumn("size", F.col("doc_size") * F.col("rows")),
        "mix-sizes",
    )
    totals = (
        units.groupBy("source")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("units"))
        .collect()
    )
    sizes = {r["source"]: r["size"] for r in totals}
    targets = source_targets(sizes, mix)
    multiplier, tilt = solve(units, sizes, targets, mix, features)
    rows = [
        (
            r["source"],
            r["size"],
            float(targets[r["source"]]),
            multiplier[r["source"]],
            r["units"] // mix.group_rows + 1,
        )
        for r in totals
    ]
    table = _local(
        units,
        rows,
        "source_size long, target double, multiplier double, groups long",
    )
    rated = _by_source(units, table).withColumns(
        {
            "rate": _rate(columns, tilt, mix),
            "tie": F.xxhash64("doc_id", "doc_size", "mark"),
            "part": F.pmod(F.xxhash64("doc_id", "mark", F.lit("part")), F.col("groups")),
        }
    )
    # A group holds about mix.group_rows documents, however large its source is.
    return rated.groupBy("source", "part").applyInPandas(_round_group, _COPIES)


#: Rows that one task makes of one input row at a time.
_SLICE = 4096


def _numbered(units: DataFrame, number: str) -> DataFrame:
    """Each row as often as a column says, numbered from 0 in column ``nr``.

    Rows that stand for many are cut into slices, which are dealt to all tasks.
    """
    last = ((F.col(number) - 1) / _SLICE).cast("long")
    first = F.col("slice") * _SLICE
    end = F.least(F.col(number), first + _SLICE) - 1
    sliced = units.filter(F.col(number) > 0).withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), last))
    )
    keys = [c for c in ("doc_id", "mark", "slice") if c in sliced.columns]
    return (
        sliced.repartition(*keys).withColumn("nr", F.explode(F.sequence(first, end))).drop("slice")
    )


def _keyed(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """The rows with what they are told apart by; ``mark`` is a hash of all columns but maps."""
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id].cast("long").alias("doc_id"),
        docs[source].alias("source"),
        word_count(docs[text]).alias("size"),
        F.xxhash64(*[docs[c] for c in hashed]).alias("mark"),
    )


def mix_sizes(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    mix: Mix = Mix(),
) -> DataFrame:
    """One row per input row: id, size, source_size, target, rate, copies and taken."""
    sized = _keyed(docs, id, text, source).drop("row")
    each = _numbered(copies(sized, mix), "rows").withColumn(
        "copies", F.col("copies") + (F.col("nr") < F.col("more")).cast("int")
    )
    return each.select(
        "doc_id",
        F.col("doc_size").alias("size"),
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("doc_size")).alias("taken"),
    )


def mix_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    mix: Mix = Mix(),
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    The copies of equal rows are made of one of them.
    """
    packed = _keyed(docs, id, text, source)
    total = (F.col("copies") * F.col("rows") + F.col("more")).alias("total")
    each = copies(packed.drop("row"), mix).select(
        "doc_id", "source", "doc_size", "mark", "rows", total
    )
    each = staged(each.filter(F.col("total") > 0), "mix-copies")

    def taken(some: DataFrame) -> DataFrame:
        same = (
            packed["doc_id"].eqNullSafe(some["doc_id"])
            & packed["source"].eqNullSafe(some["source"])
            & (packed["size"] == some["doc_size"])
            & (packed["mark"] == some["mark"])
        )
        keys = [packed[c] for c in ("row", "doc_id", "source", "size", "mark")]
        return packed.join(some, same, "inner").select(*keys, some["total"])

    single = taken(each.filter(F.col("rows") == 1))
    made = single.withColumn("nr", F.explode(F.sequence(F.lit(1).cast("long"), F.col("total"))))
    made = made.select("row.*")
    repeated = each.filter(F.col("rows") > 1)
    if repeated.isEmpty():
        return made
    # Of equal rows each map task keeps one; the copies are made of that.
    several = (
        taken(repeated)
        .groupBy("doc_id", "source", "size", "mark")
        .agg(F.first("row").alias("row"), F.first("total").alias("total"))
    )
    return made.unionAll(_numbered(several, "total").select("row.*"))
