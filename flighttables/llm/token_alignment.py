"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A (a tokenizers JSON file) encodes a space and the text; tokenizer B (a sentencepiece model), which puts that space
itself, encodes the text.  Both give tokens whose bytes, joined, are the same.

1. Each side's cumulative byte ends go into a dictionary from end to index.  The ends that both dictionaries hold are
   intersected as hash sets, sorted, and cut both id lists into groups; within a slice the two tokens that end at the
   cut are linked (all pairs of them, should a vocabulary have tokens without bytes).
   A space after a character that is no white space always starts a token of both sides, if the vocabularies allow it (checked
   when they are loaded): A's pattern never goes on across it and no piece of B holds a space after another character.
   Then the tokens of a text are those of its pieces between such spaces, and so are the groups and links; each
   distinct piece is encoded and aligned once and kept for a while.  Otherwise every text is one piece.
2. How often a pair of ids is linked is summed over the corpus: first within a chunk of documents, then over chunks.  The totals, and
   whether a pair is the commonest one of its B id, are joined back to the chunks' rows and brought together with the
   chunk's links, so a pair that every document has is a row per chunk, never a row per document or a table in memory.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, in_arrow, staged, starts_of
from flighttables.llm.chunks import pack_arrays, unpack_arrays
from flighttables.llm.token_files import _byte_alphabet

SPACE = "▁"
_SPLIT = re.compile(r"(?<=\S) (?!\Z)")
#: Pieces that a task keeps, and the longest one (in characters) that it does.
KEPT, KEPT_CHARS = 400_000, 48
#: Characters encoded at a time, and characters of a chunk (one document at least).
BLOCK_CHARS, CHUNK_CHARS = 500_000, 3_000_000


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        byte_of = {chr(c): b for b, c in _byte_alphabet().items()}
        with open(path_a, encoding="utf-8") as f:
            added = {t["id"] for t in json.load(f).get("added_tokens", [])}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.bytes_a[i] = token.encode() if i in added else bytes(byte_of[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.size_a, self.size_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.text = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.apart = self._apart(path_a)

    def _apart(self, path_a: str) -> bool:
        """Whether a space after a character that is no white space always starts a token of both tokenizers."""
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        a = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        probe = "  a \n\t  b  "  # B leaves white space as it is
        b = not any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(len(self.bytes_b))) and \
            b"".join(map(self.bytes_b.__getitem__, self.b.encode(probe))) == b" " + probe.encode()
        return bool(a and b)

    def pieces(self, text: str) -> list[str]:
        """The text cut at spaces that start a token; each piece lacks the space before it."""
        return _SPLIT.split(text) if self.apart else [text]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of A and of B of a space and each piece, and whether the joined bytes of both are the same."""
        if not pieces:
            return [], [], []
        spaced = [" " + p for p in pieces]
        a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b = self.b.encode(pieces, num_threads=1)
        joined = lambda table, ids: b"".join(map(table.__getitem__, ids))
        raw = "".join(spaced).encode()
        if joined(self.bytes_a, chain.from_iterable(a)) == raw == joined(self.bytes_b, chain.from_iterable(b)):
            if self._sums(self.size_a, a) == [len(p.encode()) for p in spaced] == self._sums(self.size_b, b):
                return a, b, [True] * len(pieces)
        return a, b, [joined(self.bytes_a, x) == p.encode() == joined(self.bytes_b, y) for x, y, p in zip(a, b, spaced)]

    @staticmethod
    def _sums(sizes: list[int], ids: list[list[int]]) -> list[int]:
        return [sum(map(sizes.__getitem__, x)) for x in ids]


@lru_cache(maxsize=1)
def _worker_tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def cuts(sizes_a: list[int], sizes_b: list[int]) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """Where each group ends in the two token lists (exclusive), and the linked pairs of token indices."""
    ends_a, ends_b = list(accumulate(sizes_a)), list(accumulate(sizes_b))
    index_a, index_b = dict(zip(ends_a, range(len(ends_a)))), dict(zip(ends_b, range(len(ends_b))))
    common = sorted(index_a.keys() & index_b.keys())
    last_a, last_b = list(map(index_a.__getitem__, common)), list(map(index_b.__getitem__, common))
    stop_a, stop_b = [i + 1 for i in last_a], [i + 1 for i in last_b]
    if len(index_a) == len(ends_a) and len(index_b) == len(ends_b):
        return stop_a, stop_b, list(zip(last_a, last_b))
    links = []  # tokens without bytes end where the token before them does
    for e, i, j in zip(common, last_a, last_b):
        first_i, first_j = i, j
        while first_i and ends_a[first_i - 1] == e:
            first_i -= 1
        while first_j and ends_b[first_j - 1] == e:
            first_j -= 1
        links += [(x, y) for x in range(first_i, i + 1) for y in range(first_j, j + 1)]
    return stop_a, stop_b, links


def group_texts(a: list[str], b: list[str], stop_a: list[int], stop_b: list[int]) -> list[str]:
    """``a1,a2|b1,b2``: the ids of each group."""
    out, i, j = [], 0, 0
    for x, y in zip(stop_a, stop_b):
        if x - i == 1 and y - j == 1:
            out.append(a[i] + "|" + b[j])
        else:
            out.append(",".join(a[i:x]) + "|" + ",".join(b[j:y]))
        i, j = x, y
    return out


class Pieces:
    """Aligned pieces: for each its figures (tokens of A and B, groups, links; -1 if not the same bytes), groups as text and link codes."""

    def __init__(self, tok: Tokenizers):
        self.tok, self.width = tok, len(tok.bytes_b)
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.said: list[str] = []
        self.figures, self.codes = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)

    def learn(self, new: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Figures, groups and link codes of pieces: they are aligned one after another, as their ends are common to both sides."""
        tok, text = self.tok, self.tok.text
        ids_a, ids_b, same = tok.encode(new)
        figures = np.zeros((len(new), 4), np.int64)
        figures[:, 0], figures[:, 1] = list(map(len, ids_a)), list(map(len, ids_b))
        good = np.array(same, bool)
        figures[~good] = (-1, 0, 0, 0)
        if not good.all():
            ids_a, ids_b = [x for x, ok in zip(ids_a, same) if ok], [x for x, ok in zip(ids_b, same) if ok]
        a, b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        stop_a, stop_b, pairs = cuts(list(map(tok.size_a.__getitem__, a)), list(map(tok.size_b.__getitem__, b)))
        groups = group_texts(list(map(text.__getitem__, a)), list(map(text.__getitem__, b)), stop_a, stop_b)
        last = np.cumsum(figures[good, 0])
        until = np.searchsorted(np.array(stop_a, np.int64), last, "right")
        at = np.array(pairs, np.int64).reshape(-1, 2)
        figures[good, 2] = np.diff(until, prepend=0)
        figures[good, 3] = np.diff(np.searchsorted(at[:, 0], last, "left"), prepend=0)
        said = [""] * len(new)
        for i, start, stop in zip(np.flatnonzero(good).tolist(), [0, *until.tolist()], until.tolist()):
            said[i] = ";".join(groups[start:stop])
        return figures, said, np.array(a, np.int64)[at[:, 0]] * self.width + np.array(b, np.int64)[at[:, 1]]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Figures and groups of the texts, and their link codes one after another."""
        if len(self.number) > KEPT:
            self.clear()
        parts = [self.tok.pieces(t) if t else [] for t in texts]
        flat = [p for x in parts for p in x]
        at = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0).tolist()
        known = len(self.said)
        if missing:
            new = list(dict.fromkeys(map(flat.__getitem__, missing)))
            place = dict(zip(new, range(known, known + len(new))))
            at[missing] = list(map(place.__getitem__, map(flat.__getitem__, missing)))
            figures, said, codes = self.learn(new)
        else:
            new, place, figures, said, codes = [], {}, np.zeros((0, 4), np.int64), [], np.zeros(0, np.int64)
        all_figures, all_said = np.concatenate((self.figures, figures)), self.said + said
        all_codes = np.concatenate((self.codes, codes))
        all_begin = np.concatenate((self.begin, len(self.codes) + starts_of(figures[:, 3])))
        n = np.array([len(p) for p in parts], np.int64)
        owner = np.repeat(np.arange(len(texts)), n)
        bad = np.bincount(owner, all_figures[at, 0] < 0, len(texts)) > 0
        keep = ~bad[owner]
        out = np.stack([np.bincount(owner[keep], all_figures[at[keep], i], len(texts)) for i in range(4)], 1).astype(np.int64)
        where, groups = at.tolist(), []
        for i, (start, size) in enumerate(zip(starts_of(n).tolist(), n.tolist())):
            groups.append("" if bad[i] or not size else ";".join(map(all_said.__getitem__, where[start:start + size])))
        sizes = all_figures[at[keep], 3]
        links = all_codes[np.repeat(all_begin[at[keep]] - starts_of(sizes), sizes) + np.arange(int(sizes.sum()))]
        short = np.array([len(p) <= KEPT_CHARS for p in new], bool)  # longer ones are not kept
        if short.all():
            self.number.update(place)
            self.figures, self.said, self.codes, self.begin = all_figures, all_said, all_codes, all_begin
        else:
            stay, rows = np.flatnonzero(short).tolist(), figures[short]
            self.number.update((new[k], known + i) for i, k in enumerate(stay))
            self.begin = np.concatenate((self.begin, len(self.codes) + starts_of(rows[:, 3])))
            self.figures, self.said = np.concatenate((self.figures, rows)), self.said + [said[k] for k in stay]
            self.codes = np.concatenate((self.codes, codes[np.repeat(short, figures[:, 3])]))
        return out, groups, links


def _aligned(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str, with_groups: bool) -> DataFrame:
    """A row per chunk: the documents' ids, figures and groups, their distinct links with counts, and their links by number."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part, seq = Pieces(_worker_tokenizers(path_a, path_b)), TaskContext.get().partitionId(), 0
        ids, figures, shas, groups, links, held = [], [], [], [], [], 0

        def close():
            nonlocal seq, ids, figures, shas, groups, links, held
            codes, number, n = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            row = pa.RecordBatch.from_arrays([
                pa.array([(part << 24) | seq], pa.int64()), pa.ListArray.from_arrays([0, len(shas)], pa.concat_arrays(ids)),
                pa.array([figures], pa.list_(pa.list_(pa.int64()))), pa.array([shas], pa.list_(pa.string())),
                pa.array([groups], pa.list_(pa.string())), pa.array([pack_arrays(codes, n)], pa.binary()),
                pa.array([pack_arrays(number.astype(np.uint32))], pa.binary())],
                names=["chunk", "ids", "figures", "shas", "groups", "pairs", "links"])
            seq, ids, figures, shas, groups, links, held = seq + 1, [], [], [], [], [], 0
            return row

        gc.disable()  # nothing here refers to itself, and the collector would walk the kept pieces again and again
        for batch in blocks(batches, "text", BLOCK_CHARS):
            texts = batch.column("text").to_pylist()
            ids.append(batch.column("id"))
            held += sum(len(t or "") for t in texts)
            rows, said, codes = pieces.align(texts)
            figures += rows.tolist()
            shas += [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in said]
            groups += said if with_groups else [None] * len(said)
            links.append(codes)
            if held >= CHUNK_CHARS:
                yield close()
        if shas:
            yield close()
        gc.enable()

    return in_arrow(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run,
                    f"chunk long, ids array<{kind}>, figures array<array<long>>, shas array<string>, groups array<string>, pairs binary, links binary")


def _pair_rows(chunks: DataFrame, width: int) -> DataFrame:
    """``(chunk, a, b, n)``: the distinct links of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("pairs").to_pylist()):
                codes, n = unpack_arrays(blob, np.int64, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), chunk)), pa.array((codes // width).astype(np.int32)),
                                                  pa.array((codes % width).astype(np.int32)), pa.array(n)], names=["chunk", "a", "b", "n"])

    return in_arrow(chunks.select("chunk", "pairs"), run, "chunk long, a int, b int, n long")


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links that are the commonest
    pair of their B id in the corpus, ties included), ``count_sum`` (corpus-wide counts of the links, added up), ``groups_sha256``,
    and with ``with_groups`` the groups as text (``groups``).

    Null and empty texts, and texts that either tokenizer doesn't give back byte for byte, have no tokens: zeros and ''.  Rows that
    repeat an id, or have none, are rows like others; other columns are ignored; an empty table gives no rows.  A text is
    encoded whole, however long it is.
    """
    import sentencepiece
    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    kind = dict(docs.dtypes)[id_col]
    chunks = staged(_aligned(docs, id_col, text_col, path_a, path_b, with_groups), "aligned-chunks")
    pairs = staged(_pair_rows(chunks, width), "aligned-pairs")
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    total = staged(total, "aligned-totals")
    most = total.groupBy("b").agg(F.max("total").alias("most"))
    total = total.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    known = pairs.join(total, ["a", "b"]).select("chunk", (F.col("a").cast("long") * width + F.col("b")).alias("code"), "total", "best")

    def run(key, chunk, known):
        rows = chunk.to_pylist()
        if not rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, types)})
        row = rows[0]
        order = np.argsort(known.column("code").to_numpy(), kind="stable")
        total, best = known.column("total").to_numpy()[order], known.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        number = unpack_arrays(row["links"], np.uint32)[0].astype(np.int64)
        figures = np.array(row["figures"], np.int64).reshape(-1, 4)
        n = figures[:, 3]
        stop = np.cumsum(n)
        add = lambda x: (lambda c: c[stop] - c[stop - n])(np.concatenate(([0], np.cumsum(x[number], dtype=np.int64))))
        ids = chunk.column("ids").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        return pa.Table.from_arrays([ids.flatten(), *(pa.array(figures[:, i]) for i in range(4)), pa.array(add(best)), pa.array(add(total)),
                                     pa.array(row["shas"], pa.string()), pa.array(row["groups"], pa.string())], names=names)

    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    types = [pa.int64()] + [pa.int64()] * 6 + [pa.string()] * 2
    schema = f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    left = chunks.select("chunk", "ids", "figures", "shas", "groups", "links")
    out = left.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)
    return out if with_groups else out.drop("groups")
