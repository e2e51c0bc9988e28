"""A compressed FM-index over integer symbols: wavelet matrix, rank and backward search.

All queries are vectors: one step of backward search serves every pattern at once.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; a shorter suffix comes first."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    width = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: max(n - width, 0)] = rank[width:]
        pair = rank * (n + 1) + second + 1
        order = np.argsort(pair, kind="stable")
        new = np.ones(n, np.int64)
        new[1:] = pair[order][1:] != pair[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        width *= 2
        if n == 0 or rank[order[-1]] == n - 1 or width >= 2 * n:
            return order


class BitVector:
    """Bits packed in 64-bit words, with the ones before each word."""

    def __init__(self, bits: np.ndarray):
        words = -(-len(bits) // 64) + 1
        packed = np.packbits(np.concatenate([bits, np.zeros(words * 64 - len(bits), bool)]), bitorder="little").view("<u8")
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int64)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FmIndex:
    """Backward search over a text of symbols below ``sigma``."""

    def __init__(self, text: np.ndarray):
        self.order = suffix_array(text)
        last = text[self.order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))]).astype(np.int64)
        self.levels = max(1, int(len(self.first) - 2).bit_length())
        # A wavelet matrix of the Burrows-Wheeler transform: one bit a level, zeros stably before ones.
        self.bits = []
        for level in reversed(range(self.levels)):
            bit = (last >> level & 1).astype(bool)
            self.bits.append(BitVector(bit))
            last = np.concatenate([last[~bit], last[bit]])
        starts = np.zeros(len(self.first) - 1, np.int64)
        symbols = np.arange(len(self.first) - 1)
        for level, bits in zip(reversed(range(self.levels)), self.bits, strict=True):
            ones = bits.ones(starts)
            starts = np.where(symbols >> level & 1, bits.zeros + ones, starts - ones)
        self.starts = starts

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position of the transform."""
        for level, bits in zip(reversed(range(self.levels)), self.bits, strict=True):
            ones = bits.ones(at)
            at = np.where(symbol >> level & 1, bits.zeros + ones, at - ones)
        return at - self.starts[symbol]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the patterns with one more symbol in front."""
        base = self.first[symbol]
        return base + self.rank(symbol, low), base + self.rank(symbol, high)
