"""How far the sources of a language diverge in their words, from in-mapper stripes.

Each task folds whole documents into hash stripes: for a language and term the number of
documents that hold it, and its occurrences by source. When the stripes of a task hold
more entries than a limit they spill, as one row a stripe; rows are dealt and sorted by
their key, and neighbours of equal key are folded again while they stream by. So a term or
source that is in every document costs one row for each spill, and no task holds more than
its own stripes or one merged stripe.

Merged stripes of terms in enough documents are kept. They are dealt over blocks of a
language, each of which meets the totals of the language's sources once and emits the
divergences of its terms: a sum for each pair of sources, and the terms by which a source
exceeds its language most. Sums of blocks add up; the best terms of a source are among the
best of its blocks.

All arithmetic is exact in whole numbers, for languages of up to 10^15 words: a share is
``1 + floor(scale * (count + 2) / (total + 2 * terms))`` with a scale of 10^9, and the
divergence of two shares ``floor((p - q)^2 / (p + q))``.

Defined results: NULL text, language and source are read as empty strings; a source whose
texts are empty or NULL still is a group, with no occurrence of any term; a language
without kept terms has pairs of value 0 and no terms; a single source has no pairs;
repeated rows count each; a text is read whole, in pieces, whatever its length; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.buffers import BLOCK
from strata.llm.frames import staged

#: Letters of ASCII and everything beyond it, in UTF-8 with A-Z already lower-cased.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")


@dataclass(frozen=True)
class Settings:
    """``entries`` bounds the stripes of a task, ``cells`` the counts of a block."""

    least_documents: int = 10
    top_terms: int = 10
    entries: int = 400_000
    cells: int = 1 << 20


_STRIPE = pa.schema(
    [
        ("lang", pa.string()),
        ("term", pa.string()),
        ("documents", pa.int64()),
        ("sources", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_STRIPE_DDL = (
    "lang string, term string, documents long, sources array<string>, counts array<long>"
)
_FOUND = "lang string, source string, part string, item string, value long"


def terms(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, piece by piece; A-Z in lower case."""
    base = 0
    while base < len(data):
        gap = _GAP.search(data, base + BLOCK) if len(data) > base + BLOCK else None
        end = gap.start() if gap else len(data)
        yield _TERM.findall(data[base:end])
        base = end


class Stripes:
    """Counts of the documents seen since the last spill."""

    def __init__(self) -> None:
        self.documents: dict[str, Counter] = defaultdict(Counter)
        self.sources: dict[str, dict[str, Counter]] = defaultdict(
            lambda: defaultdict(Counter)
        )
        self.entries = 0

    def fold(self, lang: str, source: str, data: bytes) -> None:
        holds, counts = self.documents[lang], self.sources[lang][source]
        before = len(holds) + len(counts)
        mine: set[bytes] = set()
        for piece in terms(data.lower()):
            counts.update(piece)
            mine.update(piece)
        holds.update(mine)
        self.entries += len(holds) + len(counts) - before

    def rows(self) -> pa.RecordBatch:
        """One row a stripe; the empty term tells which sources there are."""
        columns: list[list] = [[], [], [], [], []]
        for lang, sources in self.sources.items():
            names: dict[bytes, list[str]] = defaultdict(list)
            counts: dict[bytes, list[int]] = defaultdict(list)
            for source, counter in sources.items():
                for term, n in counter.items():
                    names[term].append(source)
                    counts[term].append(n)
            holds = self.documents[lang]
            columns[0] += [lang] * (len(names) + 1)
            columns[1] += ["", *(term.decode() for term in names)]
            columns[2] += [0, *(holds[term] for term in names)]
            columns[3] += [list(sources), *names.values()]
            columns[4] += [[0] * len(sources), *(counts[term] for term in names)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _STRIPE)], schema=_STRIPE
        )


def _spilled(docs: DataFrame, how: Settings) -> DataFrame:
    """The stripes of all tasks, a row for each at every spill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for lang, source, text in zip(batch.column(0), batch.column(1), texts):
                held.fold(lang.as_py(), source.as_py(), text.as_py())
                if held.entries >= how.entries:
                    yield held.rows()
                    held = Stripes()
        yield held.rows()

    return docs.mapInArrow(run, _STRIPE_DDL)


def fold_neighbours(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Stripes of equal key that follow each other as one."""
    lang, term, documents, sources, counts = batch.columns
    new = np.ones(len(batch), dtype=bool)
    new[1:] = pc.or_(
        pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])
    ).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    run = np.repeat(np.cumsum(new) - 1, pc.list_value_length(sources).to_numpy())
    coded = sources.flatten().dictionary_encode()
    names = len(coded.dictionary)
    key = run * names + coded.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.diff(key, prepend=-1))
    held = counts.flatten().to_numpy()[order]
    offsets = np.searchsorted(key[begin] // names, np.arange(len(first) + 1))
    at = pa.array(offsets.astype(np.int32))
    source = coded.dictionary.take(pa.array(key[begin] % names))
    rows = pa.array(first)
    return pa.RecordBatch.from_arrays(
        [
            lang.take(rows),
            term.take(rows),
            pa.array(np.add.reduceat(documents.to_numpy(), first)),
            pa.ListArray.from_arrays(at, source),
            pa.ListArray.from_arrays(at, pa.array(np.add.reduceat(held, begin))),
        ],
        schema=_STRIPE,
    )


def _merged(spilled: DataFrame, how: Settings) -> DataFrame:
    """One stripe for each key: kept terms, and the empty term of each language."""

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        often = pc.greater_equal(batch.column(2), how.least_documents)
        return batch.filter(pc.or_(often, pc.equal(batch.column(1), "")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not len(batch):
                continue
            batch = pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(batch.columns, _STRIPE)], schema=_STRIPE
            )
            if last is not None:
                batch = pa.concat_batches([last, batch])
            batch = fold_neighbours(batch)
            # The next batch may go on with the last key.
            last = batch.slice(len(batch) - 1)
            yield kept(batch.slice(0, len(batch) - 1))
        if last is not None:
            yield kept(last)

    dealt = spilled.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return staged(dealt.mapInArrow(run, _STRIPE_DDL), "stripes")


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(10^9 * count / total)`` for ``0 <= count <= total < 9 * 10^15``."""
    whole, rest = np.zeros_like(count), count
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // total
        rest = rest % total
    return whole + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))`` of shares."""
    return (p - q) ** 2 // (p + q)


def _divergences(how: Settings):
    """Sums for pairs of sources, and the first terms of each source, of one block."""

    def run(key: tuple, stripes: pa.Table, groups: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        groups = groups.sort_by("source")
        names = groups.column("source").combine_chunks()
        n_sources, n_terms = len(names), groups.column("kept")[0].as_py()
        totals = groups.column("total").to_numpy() + 2 * n_terms
        words = np.int64(groups.column("words")[0].as_py() + 2 * n_terms)
        stripes = stripes.sort_by("term")
        term = stripes.column("term").combine_chunks()
        lists = stripes.column("sources").combine_chunks()
        held = np.zeros((len(term), n_sources), dtype=np.int64)
        row = np.repeat(np.arange(len(term)), pc.list_value_length(lists).to_numpy())
        at = pc.index_in(lists.flatten(), names.cast(lists.flatten().type)).to_numpy()
        held[row, at] = stripes.column("counts").combine_chunks().flatten().to_numpy()
        source, part, item, value = [], [], [], []
        label = names.to_pylist()
        if n_terms:
            p = share(held + 2, totals)
            q = share(held.sum(axis=1) + 2, words)
        for s in range(n_sources):
            others = label[s + 1 :]
            sums = gap(p[:, s : s + 1], p[:, s + 1 :]).sum(axis=0) if n_terms else 0
            source += [label[s]] * len(others)
            part += ["pair"] * len(others)
            item += others
            value += np.broadcast_to(sums, len(others)).tolist()
            if not n_terms:
                continue
            above = np.flatnonzero((held[:, s] > 0) & (p[:, s] > q))
            score = gap(p[above, s], q[above])
            best = np.argsort(-score, kind="stable")[: how.top_terms]
            source += [label[s]] * len(best)
            part += ["term"] * len(best)
            item += term.take(pa.array(above[best])).to_pylist()
            value += score[best].tolist()
        return pa.table(
            {
                "lang": pa.array([lang] * len(source), pa.string()),
                "source": pa.array(source, pa.string()),
                "part": pa.array(part, pa.string()),
                "item": pa.array(item, pa.string()),
                "value": pa.array(value, pa.int64()),
            }
        )

    return run


def divergences(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    how: Settings = Settings(),
) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part ``pair`` compares a source with every other source of its language, over all kept
    terms; part ``term`` lists the terms a source uses more than its language does.
    """
    chosen = docs.select(
        *[
            F.coalesce(F.col(given), F.lit("")).alias(name)
            for name, given in (("lang", lang), ("source", source), ("text", text))
        ]
    )
    stripes = _merged(_spilled(chosen, how), how)
    each = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    totals = each.groupBy("lang", F.col("x.sources").alias("source")).agg(
        F.sum("x.counts").alias("total")
    )
    kept = stripes.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("kept"))
    totals = staged(totals, "source-totals")
    langs = staged(
        totals.groupBy("lang")
        .agg(F.sum("total").alias("words"), F.count(F.lit(1)).alias("members"))
        .join(kept, "lang")
        .withColumn(
            "blocks", F.ceil(F.greatest(F.col("kept") * F.col("members"), F.lit(1)) / how.cells)
        )
        .drop("members"),
        "lang-totals",
    )
    dealt = (
        stripes.filter(F.col("term") != "")
        .join(langs.select("lang", F.col("blocks").alias("dealt")), "lang")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("dealt")))
    )
    groups = totals.join(langs, "lang").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    found = (
        dealt.groupBy("lang", "block")
        .cogroup(groups.groupBy("lang", "block"))
        .applyInArrow(_divergences(how), _FOUND)
    )
    found = staged(found, "divergences")
    pairs = (
        found.filter(F.col("part") == "pair")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
        .select(
            "lang",
            F.explode(
                F.array(
                    F.struct("source", "item"),
                    F.struct(F.col("item").alias("source"), F.col("source").alias("item")),
                )
            ).alias("x"),
            "value",
        )
        .select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = (
        found.filter(F.col("part") == "term")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= how.top_terms)
    )
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
