"""A wavelet matrix: a sequence of small numbers, one packed bit vector for each of their bits, answering rank queries."""

from __future__ import annotations

import numpy as np


class _Bits:
    """A bit vector with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self._words = packed.view("<u8")
        self._before = np.concatenate(([0], np.cumsum(np.bitwise_count(self._words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & below)


class WaveletMatrix:
    """Rank queries over numbers of ``bits`` bits; all positions of a query are answered together."""

    def __init__(self, numbers: np.ndarray, bits: int):
        self._levels = []
        for bit in reversed(range(bits)):
            ones = (numbers >> bit & 1).astype(bool)
            self._levels.append((bit, _Bits(ones), len(numbers) - int(np.count_nonzero(ones))))
            numbers = np.concatenate((numbers[~ones], numbers[ones]))

    def rank(self, number: int, at: np.ndarray) -> np.ndarray:
        """How often the number occurs before each position."""
        low, high = np.zeros_like(at), at
        for bit, vector, zeros in self._levels:
            if number >> bit & 1:
                low, high = zeros + vector.ones(low), zeros + vector.ones(high)
            else:
                low, high = low - vector.ones(low), high - vector.ones(high)
        return high - low
