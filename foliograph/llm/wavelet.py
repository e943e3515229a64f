"""A wavelet matrix over whole numbers: ranks, order statistics and range successors, many at once."""

from __future__ import annotations

import numpy as np

from foliograph.llm.fm_index import _Bits


class WaveletMatrix:
    """``values`` are whole numbers from 0 to ``top``."""

    def __init__(self, values: np.ndarray, top: int):
        self.shifts = list(range(max(1, int(top).bit_length()) - 1, -1, -1))
        self.levels = []
        current = values
        for shift in self.shifts:
            bits = ((current >> shift) & 1).astype(np.uint8)
            self.levels.append(_Bits(bits))
            current = np.concatenate([current[bits == 0], current[bits == 1]])

    def count_less(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Values below ``x`` (at most ``top``) at places ``low`` to ``high``."""
        less = np.zeros(len(x), np.int64)
        for shift, bits in zip(self.shifts, self.levels):
            a, b = bits.ones(low), bits.ones(high)
            one = (x >> shift) & 1 == 1
            less += np.where(one, (high - low) - (b - a), 0)
            low, high = np.where(one, bits.zeros + a, low - a), np.where(one, bits.zeros + b, high - b)
        return less

    def quantile(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value number ``k`` in order, from 0, at places ``low`` to ``high``."""
        value = np.zeros(len(k), np.int64)
        for shift, bits in zip(self.shifts, self.levels):
            a, b = bits.ones(low), bits.ones(high)
            zeros = (high - low) - (b - a)
            one = k >= zeros
            k = np.where(one, k - zeros, k)
            value |= one.astype(np.int64) << shift
            low, high = np.where(one, bits.zeros + a, low - a), np.where(one, bits.zeros + b, high - b)
        return value
