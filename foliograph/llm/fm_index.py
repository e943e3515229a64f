"""A compressed full-text index over a sequence of symbols, searched backwards.

The Burrows-Wheeler transform is held in a wavelet matrix: one packed bit row
per bit of a symbol with counts every 64 bits.  Suffixes are ordered by their
first ``depth`` symbols, which is exact for patterns of up to that length.
Many patterns are searched at once.
"""

from __future__ import annotations

import numpy as np


class _Bits:
    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols or more."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    reach = 1
    while reach < depth:
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - reach, 0)] = rank[reach:] + 1
        _, rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)
        reach *= 2
    return np.argsort(rank, kind="stable")


class FmIndex:
    """``symbols`` are dense numbers from 0; ``depth`` bounds the patterns' length."""

    def __init__(self, symbols: np.ndarray, depth: int):
        order = suffix_order(symbols, depth)
        current = symbols[order - 1]  # the symbol before each suffix, the last one before the first
        size = int(symbols.max()) + 1 if len(symbols) else 1
        count = np.bincount(symbols, minlength=size)
        self.first = np.cumsum(count) - count
        self.count = count
        self.shifts = list(range(max(1, int(size - 1).bit_length()) - 1, -1, -1))
        self.levels = []
        for shift in self.shifts:
            bits = ((current >> shift) & 1).astype(np.uint8)
            self.levels.append(_Bits(bits))
            current = np.concatenate([current[bits == 0], current[bits == 1]])
        self.base = self._descend(np.arange(size), np.zeros(size, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits in zip(self.shifts, self.levels):
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1, bits.zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the patterns with ``symbol`` put in front."""
        start = self.first[symbol] - self.base[symbol]
        return start + self._descend(symbol, low), start + self._descend(symbol, high)


def matching_statistics(index: FmIndex, symbols: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """Per end place the length, up to ``limit``, of the longest stretch ending there that occurs twice or more.

    The ``limit`` symbols before every end exist.
    """
    length = np.zeros(len(ends), np.int64)
    live = np.arange(len(ends))
    symbol = symbols[ends - 1]
    low = index.first[symbol]
    high = low + index.count[symbol]
    for step in range(1, limit + 1):
        again = high - low >= 2
        live, low, high = live[again], low[again], high[again]
        length[live] = step
        if step == limit or not len(live):
            break
        low, high = index.extend(symbols[ends[live] - 1 - step], low, high)
    return length
