"""Pre-tokens of byte-level BPE: where the split pattern of the rank files cuts a text.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Its matches follow from runs of four classes of characters, so whole buffers are cut by
array operations: a run of letters, numbers or other characters takes one space before it
along; of white space before anything else the last character stands alone or is that
space; an apostrophe that stands alone takes the letters of a contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import regex

from strata.llm.buffers import BLOCK, Prefix, blocks

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)


@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, _OTHER, dtype=np.uint8)
    # Surrogates are no characters of a text.
    for first, last in ((0, 0xD800), (0xE000, 0x110000)):
        text = np.arange(first, last, dtype="<u4").tobytes().decode("utf-32-le")
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for found in regex.finditer(pattern, text):
                table[first + found.start() : first + found.end()] = kind
    return table


def starts(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the pre-tokens of the texts begin.

    ``offsets`` are the bounds of the texts in ``data``, which is UTF-8.
    """
    if not data:
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    at = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(width, out=at[1:])
    kind = _classes()[points]
    # The last place is a text start, so that every run has a place behind it.
    opens = np.zeros(len(points) + 1, dtype=bool)
    opens[np.searchsorted(at, offsets)] = True
    new = opens.copy()
    new[1:-1] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(new)
    run, end = run[:-1], run[1:]
    of = kind[run]
    begins = np.zeros(len(points) + 1, dtype=bool)
    begins[run] = True
    # White space before a run of the same text: its last character goes by itself.
    inner = (of == _SPACE) & ~opens[end]
    last = end[inner] - 1
    begins[last] = True
    spaced = last[points[last] == 0x20] + 1
    begins[spaced] = False
    # Contractions: a lone apostrophe without a space, and letters after it.
    lone = (of == _OTHER) & (end - run == 1) & ~opens[end] & begins[run]
    mark = run[lone & (points[run] == 0x27)]
    mark = mark[kind[mark + 1] == _LETTER]
    padded = np.append(points, [0, 0])
    one, two = padded[mark + 1], padded[mark + 2]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = np.zeros(len(mark), dtype=bool)
    for a, b in ("re", "ve", "ll"):
        double |= (one == ord(a)) & (two == ord(b))
    # The second letter has to be of the same text.
    double &= ~opens[np.minimum(mark + 2, len(points))]
    short = mark[single | double]
    after = short + 2 + double[single | double]
    begins[short + 1] = False
    goes_on = ~opens[after] & (kind[np.minimum(after, len(kind) - 1)] == _LETTER)
    begins[after[goes_on]] = True
    return at[:-1][begins[:-1]]


def pieces(data: bytes, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of a long text that can be cut by themselves, of about ``size`` bytes.

    A space behind a visible ASCII character always begins a pre-token.
    """
    base = 0
    for found in regex.finditer(rb"(?<=[\x21-\x7E])[\x20\n]", data):
        if found.start() - base >= size:
            yield base, found.start()
            base = found.start()
    if base < len(data):
        yield base, len(data)


def words(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pre-token of the texts begins, and a hash of its bytes."""
    found, hashes = [], []
    for first, last in blocks(offsets):
        at = int(offsets[first])
        part = data[at : int(offsets[last])]
        bounds = offsets[first : last + 1] - at
        whole = len(part) <= BLOCK or last - first > 1
        for a, b in [(0, len(part))] if whole else pieces(part):
            piece = part[a:b]
            begin = starts(piece, bounds if whole else np.array([0, b - a]))
            end = np.append(begin[1:], len(piece))
            found.append(begin + (at + a))
            hashes.append(Prefix(np.frombuffer(piece, np.uint8)).hashes(begin, end))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(found), np.concatenate(hashes)
