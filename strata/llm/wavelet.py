"""Wavelet matrix of a token sequence in one compressed file.

The sequence is stored as bit planes, highest bit first. After each plane the tokens with a
0 in it come before those with a 1, both in order, so that a token is followed down the
planes by counting bits, and an occurrence is followed up by finding them. Planes are cut
into blocks with the number of ones before each, and every block is compressed by itself:
a look-up reads one block a plane.

Layout, little endian: magic ``WVM1``; number of tokens (u8), planes (u4), bits a block
(u4); zeros of each plane (u8); per plane and block the ones before it (u8), the place of
its bytes (u8); the end of the last block (u8); the blocks.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import zstandard

MAGIC = b"WVM1"
BLOCK_BITS = 1 << 16
_HEAD = struct.Struct("<4sQII")


def build(tokens: np.ndarray, block_bits: int = BLOCK_BITS) -> bytes:
    """The file of a sequence of non-negative integers below 2**32."""
    n = len(tokens)
    planes = max(1, int(tokens.max()).bit_length()) if n else 1
    now = np.ascontiguousarray(tokens, dtype=np.uint16 if planes <= 16 else np.uint32)
    zeros, ones_before, blocks = [], [], []
    packer = zstandard.ZstdCompressor(level=1)
    step = block_bits // 8
    for plane in range(planes - 1, -1, -1):
        one = (now & now.dtype.type(1 << plane)) != 0
        bits = np.packbits(one, bitorder="little")
        count = 0
        for at in range(0, len(bits), step):
            part = bits[at : at + step]
            ones_before.append(count)
            blocks.append(packer.compress(part.tobytes()))
            count += int(np.bitwise_count(part).sum(dtype=np.int64))
        zeros.append(n - count)
        now = np.concatenate([np.compress(~one, now), np.compress(one, now)])
    head = _HEAD.pack(MAGIC, n, planes, block_bits)
    ends = np.cumsum([0] + [len(b) for b in blocks])
    table = np.empty(len(blocks) * 2 + 1, dtype="<u8")
    table[:-1:2], table[1::2], table[-1] = ones_before, ends[:-1], ends[-1]
    return b"".join(
        [head, np.array(zeros, dtype="<u8").tobytes(), table.tobytes(), *blocks]
    )


class WaveletMatrix:
    """Access, counting and search in a file made by ``build``."""

    def __init__(self, data: bytes):
        magic, self.n, self.planes, self.block_bits = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        at = _HEAD.size
        self.zeros = np.frombuffer(data, "<u8", self.planes, at).astype(np.int64)
        at += 8 * self.planes
        self.per_plane = -(-self.n // self.block_bits)
        count = self.planes * self.per_plane
        table = np.frombuffer(data, "<u8", 2 * count + 1, at).astype(np.int64)
        at += 8 * (2 * count + 1)
        self.ones = table[:-1:2].reshape(self.planes, self.per_plane)
        self.place = np.append(table[1::2], table[-1]) + at
        self.data = memoryview(data)
        self.bits = lru_cache(maxsize=256)(self._bits)

    def __len__(self) -> int:
        return self.n

    def _bits(self, plane: int, block: int) -> np.ndarray:
        """Bits of a block, one in each byte."""
        i = plane * self.per_plane + block
        raw = zstandard.decompress(self.data[self.place[i] : self.place[i + 1]])
        size = min(self.block_bits, self.n - block * self.block_bits)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=size, bitorder="little")

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, rest = divmod(i, self.block_bits)
        if block == self.per_plane:
            return self.n - int(self.zeros[plane])
        before = int(self.ones[plane, block])
        return before + int(self.bits(plane, block)[:rest].sum(dtype=np.int64))

    def _find(self, plane: int, k: int, bit: int) -> int:
        """Place of the k-th bit of a kind, from 0."""
        before = self.ones[plane]
        if not bit:
            before = np.arange(self.per_plane) * self.block_bits - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        held = np.flatnonzero(self.bits(plane, block) == bit)
        return block * self.block_bits + int(held[k - int(before[block])])

    def __getitem__(self, i: int) -> int:
        """The token at a place."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in range(self.planes):
            block, rest = divmod(i, self.block_bits)
            one = int(self.bits(plane, block)[rest])
            ones = self._ones(plane, i)
            token = token << 1 | one
            i = int(self.zeros[plane]) + ones if one else i - ones
        return token

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences in a range are after the last plane."""
        for plane in range(self.planes):
            a, b = self._ones(plane, start), self._ones(plane, end)
            if token >> (self.planes - 1 - plane) & 1:
                start, end = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in ``[start, end)``."""
        end = self.n if end is None else end
        if token < 0 or token >> self.planes:
            return 0
        a, b = self._range(token, start, end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of a token, from 0."""
        if token < 0 or token >> self.planes or k < 0:
            raise IndexError(k)
        first, last = self._range(token, 0, self.n)
        if k >= last - first:
            raise IndexError(k)
        i = first + k
        for plane in range(self.planes - 1, -1, -1):
            one = token >> (self.planes - 1 - plane) & 1
            i = self._find(plane, i - int(self.zeros[plane]) if one else i, one)
        return i

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> list[int]:
        """Places of a token in ``[start, end)``, ascending."""
        end = self.n if end is None else end
        before = self.count(token, 0, start)
        return [self.select(token, before + k) for k in range(self.count(token, start, end))]

    def decode(self) -> np.ndarray:
        """The whole sequence, from the last plane up."""
        dtype = np.uint16 if self.planes <= 16 else np.uint32
        now = np.zeros(self.n, dtype=dtype)
        for plane in range(self.planes - 1, -1, -1):
            parts = [self._bits(plane, b) for b in range(self.per_plane)]
            one = np.concatenate(parts).view(bool) if parts else np.zeros(0, bool)
            above = np.empty_like(now)
            zeros = int(self.zeros[plane])
            above[np.flatnonzero(~one)] = now[:zeros]
            bit = dtype(1 << (self.planes - 1 - plane))
            above[np.flatnonzero(one)] = now[zeros:] | bit
            now = above
        return now
