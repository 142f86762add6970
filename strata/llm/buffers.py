"""Texts of an Arrow batch as one buffer of bytes, and hashes of their words.

All functions are numpy over a buffer; none keeps state between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are worked on at once; a longer text is worked on in pieces where it can be.
BLOCK = 1 << 20

#: ASCII white space.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Everything in ASCII that is neither letter nor digit.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; NULL is empty."""
    filled = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)
    offsets = offsets[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    if data is None or not len(filled):
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    buffer = np.frombuffer(data, dtype=np.uint8)
    return buffer[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    if n:
        powers[0] = 1
    return np.multiply.accumulate(powers)


class Prefix:
    """Hashes of any range of a buffer from running sums: 64 bits, equal for equal bytes.

    Each byte has a random value, and a range is the sum of its values times powers of an
    odd base. ``family`` picks independent values and bases.
    """

    def __init__(self, data: np.ndarray, family: int = 0):
        n = len(data)
        values, up, self._down = _tables(family, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[:n], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * _ODD)


_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_KEPT: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(family: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, powers of the base and of its inverse; kept while they fit."""
    held = _KEPT.get(family)
    if held is None or len(held[1]) < n:
        base = _BASES[family]
        inverse = pow(base, -1, 1 << 64)
        values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(family))
        size = max(n, BLOCK + 4096)
        held = (
            values,
            _powers(np.uint64(base), size),
            _powers(np.uint64(inverse), size),
        )
        if size <= 4 * BLOCK:
            _KEPT[family] = held
    return held


def word_hashes(
    data: np.ndarray,
    offsets: np.ndarray,
    lower: bool = True,
    separators: np.ndarray = SPACES,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts: hash, start, end, and how many words each text has.

    Words are runs of bytes other than separators; they do not cross texts. Starts and
    ends are positions in ``data``.
    """
    hashes, starts, ends = [], [], []
    base = 0
    while base < len(data):
        stop = min(base + BLOCK, len(data))
        if stop < len(data):
            # Cut before a space or between texts; a longer word is one piece.
            gaps = np.flatnonzero(separators[data[base + 1 : stop]])
            cut = base + 1 + int(gaps[-1]) if len(gaps) else base
            at = int(np.searchsorted(offsets, stop, side="right")) - 1
            cut = max(cut, int(offsets[at]))
            if cut <= base:
                rest = np.flatnonzero(separators[data[stop:]])
                space = stop + int(rest[0]) if len(rest) else len(data)
                text = int(offsets[np.searchsorted(offsets, stop)])
                cut = min(space, text)
            stop = cut
        piece = data[base:stop]
        if lower:
            piece = _LOWER[piece]
        inside = ~separators[piece]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = offsets[(offsets > base) & (offsets < stop)] - base
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = cuts - 1
        last[before] = inside[before]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(Prefix(piece).hashes(s, e))
        starts.append(s + base)
        ends.append(e + base)
        base = stop
    if not hashes:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, np.zeros(len(offsets) - 1, np.int64)
    start = np.concatenate(starts)
    counts = np.diff(np.searchsorted(start, offsets))
    return np.concatenate(hashes), start, np.concatenate(ends), counts
