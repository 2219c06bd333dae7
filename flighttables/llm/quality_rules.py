"""Quality rules as a short-circuit cascade.

Every rule gets a block of documents as arrays and returns which of them it rejects.  On a bounded
sample each rule is timed and its rejections counted; the cascade then runs the rules by falling
rejections per second, each one only over the documents that the rules before it kept.  The order
changes the cost, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import WordCodes, blocks, in_arrow, mix64, n_spaces, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Base rule: fewer words than this, or more than this percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


@dataclass(frozen=True)
class Rule:
    """``rejects(text, tokens)`` for one document; it sees documents with at least one word."""

    name: str
    rejects: Callable[[str, list[bytes]], bool]


def _symbols(text, tokens):
    return sum(map(text.count, SYMBOLS)) > 0.1 * len(tokens)


def _shouting(text, tokens):
    letters = sum(map(str.isalpha, text))
    return letters >= 20 and sum(map(str.isupper, text)) > 0.5 * letters


def _exclaiming(text, tokens):
    return text.count("!") + text.count("?") > 0.5 * len(tokens)


def _word_length(text, tokens):
    mean = sum(map(len, tokens)) / len(tokens)
    return mean < 2 or mean > 20


def _no_letters(text, tokens):
    return sum(map(str.isalpha, text)) < 0.4 * (len(text) - n_spaces(text))


def _one_word(text, tokens):
    counts: dict[bytes, int] = {}
    for w in tokens:
        counts[w] = counts.get(w, 0) + 1
    return len(tokens) >= 20 and max(counts.values()) > 0.4 * len(tokens)


def _bullets(text, tokens):
    lines = [x.lstrip() for x in text.split("\n") if x.strip()]
    return len(lines) >= 5 and sum(x[0] in "-*•·" for x in lines) > 0.9 * len(lines)


def _cut_lines(text, tokens):
    lines = [x.rstrip() for x in text.split("\n") if x.strip()]
    return len(lines) >= 5 and sum(x.endswith(("...", "…")) for x in lines) > 0.5 * len(lines)


RULES = (Rule("symbols", _symbols), Rule("shouting", _shouting), Rule("exclaiming", _exclaiming),
         Rule("word_length", _word_length), Rule("no_letters", _no_letters), Rule("one_word", _one_word),
         Rule("bullets", _bullets), Rule("cut_lines", _cut_lines))


def repeat_words(tokens: list[list[bytes]], codes: WordCodes, window: int = WINDOW) -> np.ndarray:
    """For each document: its words inside a window of ``window`` words found twice or more in it."""
    lengths = np.array([len(t) for t in tokens], np.int64)
    out = np.zeros(len(tokens), np.int64)
    n = int(lengths.sum())
    if n < window:
        return out
    ids = codes.encode(w for t in tokens for w in t)
    owner = np.repeat(np.arange(len(tokens)), lengths)
    m = n - window + 1
    h = np.zeros(m, np.uint64)
    coded = mix64(ids.astype(np.uint64) + np.uint64(1))
    for j in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + coded[j:j + m]
    h = mix64(h ^ mix64(owner[:m].astype(np.uint64) + np.uint64(77)))
    starts = np.flatnonzero(owner[:m] == owner[window - 1:])
    order = starts[np.argsort(h[starts], kind="stable")]
    a, b = order[:-1], order[1:]
    hit = np.flatnonzero(h[a] == h[b])
    a, b = a[hit], b[hit]
    same = owner[a] == owner[b]
    for j in range(window):
        same &= ids[a + j] == ids[b + j]
    edge = np.zeros(n + 1, np.int64)
    found = np.unique(np.concatenate((a[same], b[same])))
    np.add.at(edge, found, 1)
    np.add.at(edge, found + window, -1)
    covered = np.cumsum(edge)[:n] > 0
    return np.bincount(owner[covered], minlength=len(tokens)).astype(np.int64)


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if words(x)]
    return len(lines) - len(set(lines))


def rule_costs(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int, id_col: str, text_col: str) -> DataFrame:
    """``(rule, seconds, rejections)`` on a sample of about ``sample_rows`` documents (by the hash of id and text), timed where they are."""
    kept = docs.where(docs[text_col].isNotNull())
    rows = kept.count()
    share = min(1.0, sample_rows / max(1, rows))
    chosen = F.pmod(F.xxhash64(docs[id_col].cast("string"), docs[text_col]), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for b in blocks(batches, "text"):
            texts = [(t, tokens) for t in b.column("text").to_pylist() if (tokens := words(t))]
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                rejected[k] += sum(bool(rule.rejects(t, w)) for t, w in texts)
                seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array([r.name for r in rules]), pa.array(seconds), pa.array(rejected, pa.int64())],
                                         names=["rule", "seconds", "rejections"])

    found = in_arrow(kept.where(chosen).select(docs[text_col].alias("text")), run, "rule string, seconds double, rejections long")
    return found.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejections").alias("rejections"))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int, id_col: str, text_col: str) -> list[Rule]:
    """``rules`` by falling rejections per second on the sample; a row for each rule comes to the driver."""
    gain = {r["rule"]: (r["rejections"] + 0.5) / (r["seconds"] + 1e-6) for r in rule_costs(docs, rules, sample_rows, id_col, text_col).collect()}
    return sorted(rules, key=lambda r: -gain.get(r.name, 0.0))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 500,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    ``base_failed``: fewer than 20 words, or over 30 % of them in repeated 8-word windows.  ``kept`` is
    false for these and for documents that a rule rejects.  A null or empty text has no words and fails.
    Ties and repeated rows are judged one by one; other columns are ignored.
    """
    id_type = dict(docs.dtypes)[id_col]
    ordered = order_rules(docs, rules, sample_rows, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for b in blocks(batches, "text"):
            texts = [t or "" for t in b.column("text").to_pylist()]
            tokens = [words(t) for t in texts]
            n_words = np.array([len(t) for t in tokens], np.int64)
            repeated = repeat_words(tokens, codes)
            failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)
            left = np.flatnonzero(~failed)
            for rule in ordered:
                left = np.array([i for i in left if not rule.rejects(texts[i], tokens[i])], np.int64)
            kept = np.zeros(len(texts), bool)
            kept[left] = True
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n_words), pa.array([len(t) - n_spaces(t) for t in texts], pa.int64()),
                 pa.array([sum(map(t.count, SYMBOLS)) for t in texts], pa.int64()),
                 pa.array([dup_lines(t) for t in texts], pa.int64()), pa.array(repeated),
                 pa.array(failed), pa.array(kept)],
                names=[id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return in_arrow(rows, run, f"`{id_col}` {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                               "n_repeat_words long, base_failed boolean, kept boolean")
