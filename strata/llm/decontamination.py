"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts and benchmark items are sequences of words (runs of letters and digits, A-Z in lower
case; in scripts without spaces, Chinese, Japanese, Thai, Lao, Khmer and Burmese, each
character). An item is found in a text where the edit distance in words between it and some
stretch of the text is at most ``max_percent`` of its words.

Items below ``min_words`` words are searched exactly: their whole sequence of words is one
hash, looked up among the hashes of the windows of that size in the same pass. An item of
one word thus is found in every text with that word.

The CGK embedding walks over a sequence: at each step it writes the word it stands on and
moves on or not, by a random bit of the step and the word. Two sequences a few edits apart
fall into step again after each edit, so their walks agree at most steps: edit distance has
become Hamming distance. Every item-sized window of a text is walked; a few sampled steps
are its key, and windows with the key of an item are candidates. This is repeated with new
walks and samples until the wanted recall, and candidates are confirmed by the exact edit
distance to the words that follow.

Before walking, windows are sieved by a condition that every true match meets: an edit
takes away at most one of an item's long words, so a window must hold all but that many
long words of some item of its size. The sieve works on the few words of a text that are
long words of an item at all.

Items are the query set. They are read in blocks of ``block_items``, each sent to the
tasks as arrays of that bounded size; the texts are read in place, one pass for each block,
and nothing is shuffled.

Recall, measured in the tests: whole items are always found, items with 10 % of their words
changed, dropped or added to more than 0.95.

Defined results: NULL and empty texts and items and items without any word match nothing;
items below ``min_words`` words match at distance 0 only; a text is reported once for each item with its closest stretch, the
first of equals; repeated rows are searched each by itself, repeated items too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.buffers import MARKS, mix, utf8, word_hashes


@dataclass(frozen=True)
class Settings:
    max_percent: int = 20
    min_words: int = 8
    long_word: int = 5
    repeats: int = 24
    sampled: int = 3
    size_ratio: float = 1.25
    block_items: int = 20_000
    seed: int = 5


@dataclass(frozen=True)
class SizeClass:
    """Items of about one size and their keys for every repeat.

    A window of ``window`` words must have ``needed`` long words of the items.
    ``first[r]`` marks, by 16 bits, what an item may have at the first sampled step of
    repeat r; ``keys[r]`` are the sorted keys and ``owners[r]`` the item of each.
    """

    window: int
    needed: int
    steps: np.ndarray
    factors: np.ndarray
    first: list[np.ndarray]
    keys: list[np.ndarray]
    owners: list[np.ndarray]


@dataclass(frozen=True)
class Items:
    """``table`` has a bit for each class, by 20 bits of the hash of a long word.

    ``short`` has, by number of words, sorted hashes of short items and the item of each;
    ``heads`` marks their first words by 20 bits.
    """

    ids: list[int]
    words: list[np.ndarray]
    table: np.ndarray
    classes: list[SizeClass]
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    heads: np.ndarray


_MASK = np.uint64((1 << 20) - 1)
_PAD = np.uint64(0)


def edits_allowed(n: int, how: Settings) -> int:
    return n * how.max_percent // 100


#: First and last character of the scripts without spaces.
_UNSPACED = (
    (0x0E01, 0x0EDF),
    (0x1000, 0x109F),
    (0x1780, 0x17D3),
    (0x3005, 0x3007),
    (0x3041, 0x30FA),
    (0x30FC, 0x30FF),
    (0x31F0, 0x31FF),
    (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0x20000, 0x3FFFF),
)
#: Marks of these scripts.
_UNSPACED_MARKS = (
    (0x104A, 0x104F),
    (0x17D4, 0x17DA),
    (0x3000, 0x3004),
    (0x3008, 0x3040),
    (0x30FB, 0x30FB),
    (0xFF00, 0xFF0F),
    (0xFF1A, 0xFF20),
    (0xFF3B, 0xFF40),
    (0xFF5B, 0xFF65),
)


def _within(code: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    inside = np.zeros(len(code), dtype=bool)
    for first, last in ranges:
        inside |= (code >= first) & (code <= last)
    return inside


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where characters of scripts without spaces start, their bytes, which are marks."""
    three = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
    four = np.flatnonzero(data >= 0xF0)
    d = data.astype(np.int32)

    def tail(at: np.ndarray, k: int) -> np.ndarray:
        return d[at + k] & 0x3F

    code3 = (d[three] & 0x0F) << 12 | tail(three, 1) << 6 | tail(three, 2)
    code4 = (d[four] & 0x07) << 18 | tail(four, 1) << 12 | tail(four, 2) << 6
    code4 |= tail(four, 3)
    at = np.concatenate([three, four])
    code = np.concatenate([code3, code4])
    size = np.repeat(np.array([3, 4]), [len(three), len(four)])
    marks = _within(code, _UNSPACED_MARKS)
    keep = np.flatnonzero(marks | _within(code, _UNSPACED))
    keep = keep[np.argsort(at[keep])]
    return at[keep], size[keep], marks[keep]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their lengths in bytes, and the number of words of each text.

    A character of a script without spaces is a word, and as rare as a long one.
    """
    data, offsets = utf8(texts)
    if not (data >= 0xE0).any():
        hashes, starts, ends, counts = word_hashes(data, offsets, separators=MARKS)
        return hashes, ends - starts, counts
    at, size, marks = _unspaced(data)
    # The words between these characters, as if they were blank.
    rest = data.copy()
    for k in range(4):
        rest[at[size > k] + k] = 32
    hashes, starts, ends, _ = word_hashes(rest, offsets, separators=MARKS)
    at, size = at[~marks], size[~marks]
    code = np.zeros(len(at), dtype=np.uint64)
    for k in range(4):
        own = size > k
        code[own] = code[own] << np.uint64(8) | data[at[own] + k]
    start = np.concatenate([starts, at])
    order = np.argsort(start, kind="stable")
    lengths = np.concatenate([ends - starts, np.full(len(at), 1 << 20)])
    hashes = np.concatenate([hashes, mix(mix(code) + np.uint64(1))])
    counts = np.diff(np.searchsorted(start[order], offsets))
    return hashes[order], lengths[order], counts


def _sequences(words: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each start."""
    key = np.full(len(start), n, dtype=np.uint64)
    for k in range(n):
        key = mix(key + words[start + k])
    return key


def _short_items(
    words: list[np.ndarray], how: Settings
) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hashes of the items below ``min_words`` words, and marks of their first words."""
    sizes: dict[int, list[int]] = {}
    heads = np.zeros(1 << 20, dtype=bool)
    for i, w in enumerate(words):
        if 0 < len(w) < how.min_words:
            sizes.setdefault(len(w), []).append(i)
            heads[int(w[0] & _MASK)] = True
    short = {}
    for n, group in sizes.items():
        joined = np.concatenate([words[i] for i in group])
        key = _sequences(joined, np.arange(len(group)) * n, n)
        rank = np.argsort(key, kind="stable")
        short[n] = key[rank], np.array(group)[rank]
    return short, heads


def _exact(
    words: np.ndarray, end: np.ndarray, text_of: np.ndarray, items: Items
) -> Iterator[tuple[int, int]]:
    """``(start, item)`` of the first place of each short item in each text."""
    if not items.short:
        return
    at = np.flatnonzero(items.heads[(words & _MASK).astype(np.int64)])
    for n, (keys, owners) in items.short.items():
        start = at[at + n <= end[at]]
        key = _sequences(words, start, n)
        low = np.searchsorted(keys, key)
        hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == key)
        # The first place for each text and key.
        _, first = np.unique(
            np.stack([text_of[start[hit]], low[hit]]), axis=1, return_index=True
        )
        for i in hit[first].tolist():
            k = int(low[i])
            while k < len(keys) and keys[k] == key[i]:
                yield int(start[i]), int(owners[k])
                k += 1


def _step(
    words: np.ndarray, at: np.ndarray, end: np.ndarray, factor: np.uint64 | None
) -> tuple[np.ndarray, np.ndarray]:
    """The words the walks stand on, a pad past the end, and where they go next."""
    word = np.where(at < end, words[np.minimum(at, len(words) - 1)], _PAD)
    if factor is None:
        return word, at
    return word, at + (word * factor >> np.uint64(63)).astype(np.int64)


def _keys(
    words: np.ndarray,
    start: np.ndarray,
    end: np.ndarray,
    steps: np.ndarray,
    factors: np.ndarray,
    first: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Index and key of the windows from ``start``.

    With ``first``, windows that no item can match after the first sampled step are left.
    """
    index, at = np.arange(len(start)), start
    key = np.zeros(len(start), dtype=np.uint64)
    t = 0
    for n, wanted in enumerate(steps.tolist()):
        while t < wanted:
            _, at = _step(words, at, end, factors[t])
            t += 1
        word, after = _step(words, at, end, factors[t])
        key = mix(key + word)
        if n == 0 and first is not None:
            keep = np.flatnonzero(first[(key & _LOW).astype(np.int64)])
            index, after, end, key = index[keep], after[keep], end[keep], key[keep]
        at, t = after, t + 1
    return index, key


_LOW = np.uint64((1 << 16) - 1)
#: Classes of items by how many of their long words a window must have.
_NEEDED = (0, 1, 2, 3, 5, 8, 12, 20)


def _groups(sizes: list[int], needed: list[int], how: Settings) -> list[list[int]]:
    """Items of about one size and need together; sizes within ``size_ratio``."""
    level = [sum(n >= x for x in _NEEDED) for n in needed]
    groups: dict[tuple[int, int], list[int]] = {}
    base, step = 0, -1
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        if sizes[i] < how.min_words:
            continue
        if sizes[i] > how.size_ratio * base:
            base, step = sizes[i], step + 1
        groups.setdefault((step, level[i]), []).append(i)
    return list(groups.values())


def prepare(ids: list[int], texts: list[str | None], how: Settings = Settings()) -> Items:
    """Keys of a block of items, by size class."""
    hashes, lengths, counts = _words(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    words = [hashes[e - c : e] for e, c in zip(ends, counts)]
    is_long = lengths >= how.long_word
    long = [w[is_long[e - c : e]] for w, e, c in zip(words, ends, counts)]
    sizes = [len(w) for w in words]
    needed = [max(len(x) - edits_allowed(n, how), 0) for x, n in zip(long, sizes)]
    groups = _groups(sizes, needed, how)
    random = np.random.default_rng(how.seed)
    table = np.zeros(1 << 20, dtype=np.uint64)
    classes = []
    for number, group in enumerate(groups):
        least, most = sizes[group[0]], sizes[group[-1]]
        # Classes beyond the 64th share bits: their windows are sieved less.
        bit = np.uint64(1 << number % 64)
        for i in group:
            table[(long[i] & _MASK).astype(np.int64)] |= bit
        reach = max(how.sampled, 3 * least // 2)
        steps = np.array(
            [
                np.sort(random.choice(reach, how.sampled, replace=False))
                for _ in range(how.repeats)
            ]
        )
        factors = random.integers(0, 1 << 63, (how.repeats, reach), dtype=np.uint64)
        factors = factors * np.uint64(2) + np.uint64(1)
        size = SizeClass(
            most + edits_allowed(most, how),
            min(needed[i] for i in group),
            steps,
            factors,
            [],
            [],
            [],
        )
        joined = np.concatenate([words[i] for i in group])
        stop = np.cumsum([sizes[i] for i in group])
        start = stop - [sizes[i] for i in group]
        for r in range(how.repeats):
            _, head = _keys(joined, start, stop, steps[r][:1], factors[r])
            mark = np.zeros(1 << 16, dtype=bool)
            mark[(head & _LOW).astype(np.int64)] = True
            _, key = _keys(joined, start, stop, steps[r], factors[r])
            rank = np.argsort(key, kind="stable")
            size.first.append(mark)
            size.keys.append(key[rank])
            size.owners.append(np.array(group)[rank])
        classes.append(size)
    return Items(ids, words, table, classes, *_short_items(words, how))


def _sieved(
    hits: np.ndarray, first: np.ndarray, end: np.ndarray, size: SizeClass, n: int
) -> np.ndarray:
    """Starts of windows with enough of the words at ``hits``, ascending.

    ``first`` and ``end`` bound the text of each word.
    """
    if size.needed == 0:
        return np.arange(n)
    if len(hits) < size.needed:
        return np.zeros(0, dtype=np.int64)
    low, high = hits[: len(hits) - size.needed + 1], hits[size.needed - 1 :]
    begin = np.maximum(high - size.window + 1, first[low])
    fits = np.flatnonzero((begin <= low) & (high < end[low]))
    begin, last = begin[fits], low[fits]
    if not len(begin):
        return begin
    begin[1:] = np.maximum(begin[1:], last[:-1] + 1)
    count = np.maximum(last - begin + 1, 0)
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _candidates(
    words: np.ndarray, first: np.ndarray, end: np.ndarray, items: Items
) -> Iterator[tuple[int, int]]:
    """``(start, item)`` of windows that share a key with an item; may repeat."""
    mask = items.table[(words & _MASK).astype(np.int64)]
    some = np.flatnonzero(mask)
    mask = mask[some]
    for number, size in enumerate(items.classes):
        hits = some[(mask & np.uint64(1 << number % 64)) != 0]
        active = _sieved(hits, first, end, size, len(words))
        if not len(active):
            continue
        stop = end[active]
        for r in range(len(size.keys)):
            index, key = _keys(
                words, active, stop, size.steps[r], size.factors[r], size.first[r]
            )
            at = np.searchsorted(size.keys[r], key)
            last = len(size.keys[r]) - 1
            hit = np.flatnonzero(size.keys[r][np.minimum(at, last)] == key)
            for i in hit.tolist():
                k = int(at[i])
                while k <= last and size.keys[r][k] == key[i]:
                    yield int(active[index[i]]), int(size.owners[r][k])
                    k += 1


def distance(item: list[int], text: list[int], most: int) -> int | None:
    """Least edit distance between an item and a beginning of a text, if at most ``most``."""
    if item == text[: len(item)]:
        return 0
    common = sum((Counter(item) & Counter(text)).values())
    if len(item) - common > most:
        return None
    # Row j: distances of the item's first j words to each beginning of the text, in the
    # band that ``most`` edits can reach; all others are too far.
    far = most + 1
    row = list(range(len(text) + 1))
    for j, word in enumerate(item, 1):
        above, row = row, [j] + [far] * len(text)
        low, high = max(1, j - most), min(len(text), j + most)
        for i in range(low, high + 1):
            row[i] = min(
                above[i - 1] + (word != text[i - 1]), row[i - 1] + 1, above[i] + 1
            )
        if min(row) > most:
            return None
    best = min(row)
    return best if best <= most else None


def search(
    texts: pa.Array, items: Items, how: Settings = Settings()
) -> list[tuple[int, int, int, int]]:
    """``(text, item, first word, distance)`` for each text and item that match."""
    words, _, counts = _words(texts)
    if not len(words):
        return []
    stops = np.cumsum(counts)
    text_of = np.repeat(np.arange(len(counts)), counts)
    end = stops[text_of]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    seen: set[tuple[int, int]] = set()
    first = stops - counts
    for start, item in _exact(words, end, text_of, items):
        best[int(text_of[start]), item] = (0, start)
    for start, item in _candidates(words, first[text_of], end, items):
        if (start, item) in seen:
            continue
        seen.add((start, item))
        text = int(text_of[start])
        known = best.get((text, item))
        target = items.words[item]
        most = edits_allowed(len(target), how)
        if known and known[0] == 0 and known[1] <= start:
            continue
        window = words[start : min(start + len(target) + most, int(end[start]))]
        d = distance(target.tolist(), window.tolist(), most)
        if d is not None and (known is None or (d, start) < known):
            best[text, item] = (d, start)
    return [
        (text, items.ids[item], start - int(first[text]), d)
        for (text, item), (d, start) in sorted(best.items())
    ]


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    how: Settings = Settings(),
) -> DataFrame:
    """One row per matching text and item: doc_id, item_id, first_word, distance."""
    chosen = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = benchmark.select(
        F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")
    ).filter("id is not null and text is not null")
    schema = "doc_id long, item_id long, first_word long, distance int"
    found = docs.sparkSession.createDataFrame([], schema)
    stream = rows.orderBy("id", "text").toLocalIterator()
    while block := list(islice(stream, how.block_items)):
        items = prepare([r["id"] for r in block], [r["text"] for r in block], how)
        shared = docs.sparkSession.sparkContext.broadcast(items)
        found = found.unionAll(_search_block(chosen, shared, how, schema))
    return found


def _search_block(chosen: DataFrame, shared, how: Settings, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            found = search(batch.column(1), shared.value, how)
            texts, items, first, distances = (
                ([x[k] for x in found] for k in range(4)) if found else ([], [], [], [])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(texts, pa.int64())),
                    pa.array(items, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(distances, pa.int32()),
                ],
                names=["doc_id", "item_id", "first_word", "distance"],
            )

    return chosen.mapInArrow(run, schema)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    how: Settings = Settings(),
) -> DataFrame:
    """The rows whose text matches no item, with all their columns.

    Rows are told apart by id and text, so a row without id is judged by its text too.
    """
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[text].alias("text"),
        F.xxhash64(docs[id], docs[text], F.lit("row")).alias("key"),
    )
    keyed = packed.select(F.col("key").alias("doc_id"), "text")
    bad = (
        matches(keyed, benchmark, how=how)
        .select(F.col("doc_id").alias("bad"))
        .distinct()
    )
    return packed.join(bad, packed["key"] == bad["bad"], "left_anti").select("row.*")
