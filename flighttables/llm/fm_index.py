"""A compressed full-text index (FM-index) over sequences of integer symbols, in numpy.

The Burrows-Wheeler transform of the text is held in a wavelet matrix: one bit vector per bit of the symbols, packed
into 64-bit words with running counts.  A backward step narrows the interval of the rows that start with a pattern by
one more symbol on the left, for many patterns at once.
"""

from __future__ import annotations

import numpy as np

from flighttables.llm.decontamination import suffix_array


class BitVector:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        words = np.zeros(n // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words))[:-1])).astype(np.int64)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class FMIndex:
    """Index of ``text``: symbols from 1, with a 0 after each sequence (each 0 a terminator of its own, by place)."""

    def __init__(self, text: np.ndarray, depth: int):
        """``depth`` symbols are what patterns have at most; rows are ordered that far."""
        n = len(text)
        self.order = np.concatenate((np.flatnonzero(text == 0), suffix_array(text, depth)))
        bwt = text[self.order - 1]  # before the first symbol: the last one, a terminator
        size = int(text.max(initial=0)) + 1
        self.levels = max(1, int(size - 1).bit_length())
        first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))[:-1]
        self.vectors, self.zeros = [], []
        seq = bwt
        for level in range(self.levels - 1, -1, -1):
            bits = ((seq >> level) & 1).astype(bool)
            self.vectors.append(BitVector(bits))
            self.zeros.append(n - int(bits.sum()))
            seq = np.concatenate((seq[~bits], seq[bits]))
        at = self._walk(np.arange(size), np.zeros(size, np.int64))
        self.shift = first - at  # from a symbol's block at the last level to its rows

    def _walk(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, vector, zeros in zip(range(self.levels - 1, -1, -1), self.vectors, self.zeros):
            ones = vector.rank1(i)
            i = np.where((symbols >> level) & 1, zeros + ones, i - ones)
        return i

    def back(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbols`` followed by what ``[lo, hi)`` starts with."""
        return self._walk(symbols, lo) + self.shift[symbols], self._walk(symbols, hi) + self.shift[symbols]

    def statistics(self, patterns: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics: for each place ``ends`` of ``patterns`` the longest match that ends before it (up to
        ``most`` symbols, not across a 0), and its interval of rows."""
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.order), np.int64)
        length = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        for step in range(1, most + 1):
            at = ends[live] - step
            ok = at >= 0
            live, at = live[ok], at[ok]
            symbols = patterns[at]
            a, b = self.back(symbols, lo[live], hi[live])
            ok = (symbols > 0) & (b > a)
            live = live[ok]
            lo[live], hi[live] = a[ok], b[ok]
            length[live] = step
            if not len(live):
                break
        return length, lo, hi
