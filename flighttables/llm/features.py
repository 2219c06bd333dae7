"""Features of a text for the trained models: hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np

from flighttables.llm._common import KEPT_WORD, n_spaces, words

SYMBOLS = "#*$%&|<>"
#: Structure statistics and metadata come first, then the hashed words.
STATISTICS = ("symbols", "bars", "exclaims", "capitals", "digits", "stops", "word_length", "distinct", "top_word",
              "same_next", "line_length", "dup_lines", "log_words", "log_chars", "empty", "plain_words")
N_STATS = len(STATISTICS)


class TextFeatures:
    """Sparse feature vectors of texts: indexes and values, ``2 ** bits`` word buckets after the statistics."""

    def __init__(self, bits: int, cache: int = 400_000):
        self.mask, self.limit, self.cache = (1 << bits) - 1, cache, {}
        self.size = N_STATS + (1 << bits)

    def __call__(self, text: str | None, n_chars: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """``(indexes, values, number of words)``; a word bucket's value falls with the number of distinct words."""
        text = text or ""
        tokens = words(text)
        counts = Counter(tokens)
        cache, mask = self.cache, self.mask
        if len(cache) > self.limit:
            cache.clear()
        buckets = []
        for w in counts:
            b = cache.get(w)
            if b is None:
                b = N_STATS + (zlib.crc32(w.lower()) & mask)
                if len(w) <= KEPT_WORD:
                    cache[w] = b
            buckets.append(b)
        at = np.unique(np.array(buckets, np.int64)) if buckets else np.zeros(0, np.int64)
        index = np.concatenate((np.arange(N_STATS), at))
        value = np.concatenate((self.statistics(text, tokens, counts, n_chars),
                                np.full(len(at), 2.0 / np.sqrt(max(1, len(at))))))
        return index, value, len(tokens)

    @staticmethod
    def statistics(text, tokens, counts, n_chars) -> np.ndarray:
        n = max(1, len(tokens))
        chars = max(1, len(text) - n_spaces(text))
        raw = np.frombuffer(text.encode(), np.uint8)
        by = np.bincount(raw, minlength=128) if len(raw) else np.zeros(128, np.int64)
        lines = [x for x in text.split("\n") if x.strip()]
        same = sum(map(eq, tokens, tokens[1:]))
        symbols = int(sum(by[ord(c)] for c in SYMBOLS))
        capitals, digits = int(by[65:91].sum()), int(by[48:58].sum())
        return np.array([
            min(2.0, symbols / n), min(2.0, by[ord("|")] / n), min(2.0, by[ord("!")] / n), capitals / chars * 2, digits / chars * 2,
            min(2.0, (by[ord(".")] + by[ord(",")]) / n), min(3.0, chars / n / 6), len(counts) / n,
            max(counts.values(), default=0) / n * 2, same / n * 2, min(2.0, n / max(1, len(lines)) / 50),
            (len(lines) - len(set(lines))) / max(1, len(lines)), np.log1p(len(tokens)) / 8,
            np.log1p(max(0, n_chars if n_chars is not None else len(text))) / 10, float(not tokens),
            1 - min(1.0, symbols / n)])


def csr(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as one ``(starts, indexes, values)``; every row has at least the statistics."""
    lengths = np.array([len(i) for i, _ in rows], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    return starts, np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
