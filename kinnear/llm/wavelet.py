"""A wavelet matrix: a sequence of integers in succinct bit planes.

The symbols are numbered within their alphabet.  Plane 0 holds the highest
bit of every number; the sequence is then stably dealt into zeros and ones
before plane 1 is taken, and so on.  A directory holds the ones before every
block of 512 bits, so rank needs one popcount of at most 512 bits.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

BLOCK = 512


@dataclass
class WaveletMatrix:
    length: int
    alphabet: np.ndarray  # sorted distinct symbols, uint32
    planes: np.ndarray  # (levels, blocks * 64) uint8, most significant bit first
    ones: np.ndarray  # (levels, blocks + 1) uint32: ones before each block

    @classmethod
    def build(cls, symbols: np.ndarray) -> WaveletMatrix:
        n = len(symbols)
        highest = int(symbols.max()) if n else 0
        seen = np.zeros(highest + 1, bool)
        seen[symbols] = True
        alphabet = np.flatnonzero(seen).astype(np.uint32) if n else np.zeros(0, np.uint32)
        kind = np.uint16 if len(alphabet) <= 65536 else np.uint32
        number = np.zeros(highest + 1, kind)
        number[alphabet] = np.arange(len(alphabet), dtype=kind)
        a = number[symbols] if n else np.zeros(0, kind)
        levels = max(1, int(len(alphabet) - 1).bit_length()) if n else 0
        blocks = -(-n // BLOCK)
        planes = np.zeros((levels, blocks * BLOCK // 8), np.uint8)
        ones = np.zeros((levels, blocks + 1), np.uint32)
        for level in range(levels):
            bit = (a & kind(1 << (levels - 1 - level))).astype(bool)
            packed = np.packbits(bit)
            planes[level, :len(packed)] = packed
            counts = np.bitwise_count(planes[level].view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
            np.cumsum(counts, out=ones[level, 1:])
            if level < levels - 1:
                a = np.concatenate([a.take(np.flatnonzero(~bit)), a.take(np.flatnonzero(bit))])  # far faster than masks
        return cls(n, alphabet, planes, ones)

    @property
    def levels(self) -> int:
        return len(self.planes)

    def _zeros(self, level: int) -> int:
        return self.length - int(self.ones[level, -1])

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, BLOCK)
        total = int(self.ones[level, block])
        if rest:
            part = self.planes[level, block * BLOCK // 8: block * BLOCK // 8 + BLOCK // 8]
            total += int(np.unpackbits(part, count=rest).sum())
        return total

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (7 - (i & 7)) & 1

    def _number(self, symbol: int) -> int | None:
        at = int(np.searchsorted(self.alphabet, symbol))
        return at if at < len(self.alphabet) and int(self.alphabet[at]) == symbol else None

    def access(self, i: int) -> int:
        """The symbol at place ``i``."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        number = 0
        for level in range(self.levels):
            bit, one = self._bit(level, i), self._rank1(level, i)
            number = number << 1 | bit
            i = self._zeros(level) + one if bit else i - one
        return int(self.alphabet[number])

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` occurs among the first ``i`` symbols."""
        number = self._number(symbol)
        if number is None:
            return 0
        low, high = self._interval(number, i)
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.length)

    def _interval(self, number: int, i: int) -> tuple[int, int]:
        low, high = 0, i
        for level in range(self.levels):
            one_low, one_high = self._rank1(level, low), self._rank1(level, high)
            if number >> (self.levels - 1 - level) & 1:
                low, high = self._zeros(level) + one_low, self._zeros(level) + one_high
            else:
                low, high = low - one_low, high - one_high
        return low, high

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) such bit of a plane."""
        before = self.ones[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(self.planes[level, block * BLOCK // 8: (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - before[block]])

    def select(self, symbol: int, k: int) -> int:
        """The place of the ``k``-th occurrence (from 0) of ``symbol``."""
        number = self._number(symbol)
        if number is None or not 0 <= k < self.count(symbol):
            raise IndexError(k)
        place = self._interval(number, 0)[0] + k
        for level in reversed(range(self.levels)):
            if number >> (self.levels - 1 - level) & 1:
                place = self._select(level, 1, place - self._zeros(level))
            else:
                place = self._select(level, 0, place)
        return place

    def occurrences(self, symbol: int) -> list[int]:
        """All places of ``symbol``, ascending."""
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def decode(self) -> np.ndarray:
        """All symbols in order: the deals are undone from the last plane up."""
        n = self.length
        if not n:
            return np.zeros(0, np.uint32)
        kind = np.uint16 if len(self.alphabet) <= 65536 else np.uint32
        a = np.zeros(n, kind)
        for level in reversed(range(self.levels)):
            bit = np.unpackbits(self.planes[level], count=n).view(bool)
            zeros = self._zeros(level)
            back = np.empty(n, kind)
            back[np.flatnonzero(~bit)] = a[:zeros]
            back[np.flatnonzero(bit)] = a[zeros:] | kind(1 << (self.levels - 1 - level))
            a = back
        return self.alphabet[a]

    def to_bytes(self) -> bytes:
        """length, alphabet size, levels (little-endian 64-bit), alphabet, planes, directory."""
        head = struct.pack("<QQQ", self.length, len(self.alphabet), self.levels)
        return b"".join([head, self.alphabet.astype("<u4").tobytes(), self.planes.tobytes(), self.ones.astype("<u4").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        length, size, levels = struct.unpack_from("<QQQ", data)
        blocks = -(-length // BLOCK)
        at = 24
        alphabet = np.frombuffer(data, "<u4", size, at)
        at += 4 * size
        planes = np.frombuffer(data, np.uint8, levels * blocks * BLOCK // 8, at).reshape(levels, blocks * BLOCK // 8)
        at += planes.size
        ones = np.frombuffer(data, "<u4", levels * (blocks + 1), at).reshape(levels, blocks + 1)
        return cls(length, alphabet, planes, ones)
