"""Removal of repeated passages with FM-indexes of the passages that can repeat.

A window is ``window`` consecutive words.  Of its (``window - GRAM + 1``) word ``GRAM``-grams the one of least hash is
the window's anchor, so equal windows have equal anchors.

1. Documents are packed into chunks; each chunk counts the hashes of its anchors, and the counts are summed.
2. Of the anchors that occur twice or more each chunk cuts the passages: the words of the windows that have the
   anchor.  Within a chunk equal passages are one, with the first place.  The windows of an anchor with more than
   ``hot`` occurrences are passages of their own, so that one frequent anchor does not make one large group.
3. Passages are dealt to shards by anchor (those of hot anchors by their words), packed by chunk.  A shard builds a compressed
   FM-index of its distinct passages and streams their words through it: backward search gives the matching
   statistics; where they reach the threshold the interval of rows gives all places of the window, so the first.
4. A window is dropped if its first place is an earlier one; passages that are not the first of their words are dropped
   whole.  The chunks take the verdicts back and remove the words that dropped windows cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flighttables.llm._common import SPACES, in_arrow, mix64, ship_package, staged, starts_of
from flighttables.llm.chunks import pack, pack_arrays, unpack, unpack_arrays
from flighttables.llm.fm_index import FMIndex

WINDOW, GRAM = 20, 10
HOT = 20_000


_ODD = 0x9E3779B97F4A7C15
_BLOCK = 1 << 22
_IS_SPACE = np.array([c in SPACES for c in range(256)])


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, for a block of bytes."""
    one = np.full(_BLOCK, _ODD, np.uint64), np.full(_BLOCK, pow(_ODD, -1, 1 << 64), np.uint64)
    for p in one:
        p[0] = 1
    return np.cumprod(one[0]), np.cumprod(one[1])


def hash_words(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, starts, ends, hashes, words per text)`` of the words of the texts one after another.

    The hash of a word is a polynomial in its bytes, taken for a whole block of text at once from running sums.  It only
    picks anchors: equal words have equal hashes, and what other words share a hash is told apart by the words later.
    A word of more than a block goes by its first block.
    """
    raw = b"\n".join(texts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    edge = edge if space[0] else np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    out = np.zeros(len(starts), np.uint64)
    power, inverse = _powers()
    at = 0
    while at < len(starts):
        first = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, first + _BLOCK, "right")))
        last = min(int(ends[upto - 1]), first + _BLOCK)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * power[:last - first])))
        s, e = starts[at:upto] - first, np.minimum(ends[at:upto], last) - first
        out[at:upto] = (sums[e] - sums[s]) * inverse[s]
        at = upto
    begin = starts_of(np.array([len(t) + 1 for t in texts], np.int64))
    counts = np.diff(np.append(np.searchsorted(starts, begin), len(starts)))
    return raw, starts, ends, mix64(out ^ mix64((ends - starts).astype(np.uint64))), counts


def anchors(hashes: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: ``(anchor hash, first window, windows)``.

    ``hashes`` are those of the words of documents of ``lengths`` one after another; windows are places there.
    """
    none = np.zeros(0, np.int64)
    n = len(hashes)
    m = n - window + 1
    if m <= 0:
        return none.astype(np.uint64), none, none
    owner = np.repeat(np.arange(len(lengths)), lengths)
    g = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        g = g * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + len(g)]
    g = mix64(g)
    bits = np.uint64(int(n).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    best = (g & ~low) | np.arange(len(g), dtype=np.uint64)  # the least hash, of equal ones the first place
    span = window - gram + 1
    width = 1
    while width * 2 <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[:len(best) - (span - width)], best[span - width:])
    starts = np.flatnonzero(owner[:m] == owner[window - 1:])
    if not len(starts):
        return none.astype(np.uint64), none, none
    place = (best[starts] & low).astype(np.int64)
    head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1))))
    return g[place[head]], starts[head], np.diff(np.append(head, len(starts)))


def count_anchors(chunks: DataFrame, window: int, gram: int) -> DataFrame:
    """``(hash, chunk, n)``: anchors of each chunk with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, _, h, lengths = hash_words(unpack(batch.column("texts")[i].as_py()))
                found, n = np.unique(anchors(h, lengths, window, gram)[0], return_counts=True)
                chunk = np.full(len(found), batch.column("chunk")[i].as_py())
                for at in range(0, len(found), 100_000):
                    s = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(found[s].view(np.int64)), pa.array(chunk[s]), pa.array(n[s])],
                                                     names=["hash", "chunk", "n"])

    return in_arrow(chunks.select("chunk", "texts"), run, "hash long, chunk long, n long")


def cut_passages(ids: list, texts: list[bytes], repeated: np.ndarray, hot: np.ndarray, shards: int, window: int, gram: int):
    """Passages of one chunk.

    Returns ``(passages, places)``: passages ``(shard, document, first window in it, words)`` that are distinct in the
    chunk, at their first place by id and order; places ``(document, first window, windows, passage)`` of all of them.
    """
    raw, starts, ends, h, lengths = hash_words(texts)
    h, first, n = anchors(h, lengths, window, gram)
    some = np.isin(h, repeated)
    h, first, n = h[some], first[some], n[some]
    split = np.isin(h, hot)
    each = np.repeat(first[split] - starts_of(n[split]), n[split]) + np.arange(int(n[split].sum()))  # a passage a window
    route = np.concatenate((h[~split], np.zeros(len(each), np.uint64)))
    first = np.concatenate((first[~split], each))
    n = np.concatenate((n[~split], np.ones(len(each), np.int64)))
    begin = starts_of(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)[first]
    order = np.lexsort((first, _order(ids)[doc]))
    number: dict[bytes, int] = {}
    passages, of = [], np.zeros(len(first), np.int64)
    spans = starts[first[order]].tolist(), ends[first[order] + n[order] + window - 2].tolist()
    for i, s, e, a, d, r in zip(order.tolist(), *spans, first[order].tolist(), doc[order].tolist(), route[order].tolist()):
        text = b" ".join(raw[s:e].split())
        p = number.get(text)
        if p is None:
            p = number[text] = len(passages)
            passages.append(((r or xxhash.xxh3_64_intdigest(text)) % shards, d, a - int(begin[d]), text))
        of[i] = p
    return passages, (doc, first - begin[doc], n, of)


def pack_passages(passages: list[tuple]) -> dict[int, tuple[list[int], bytes]]:
    """By shard: the documents and one blob of the passages' numbers, documents, first windows and words."""
    by: dict[int, list[int]] = {}
    for p, row in enumerate(passages):
        by.setdefault(row[0], []).append(p)
    out = {}
    for shard, mine in by.items():
        rows = [passages[p] for p in mine]
        out[shard] = ([r[1] for r in rows], pack_arrays(np.array(mine, np.int32), np.array([r[1] for r in rows], np.int32),
                                                       np.array([r[2] for r in rows], np.int32),
                                                       np.frombuffer(b"\n".join(r[3] for r in rows), np.uint8)))
    return out


def unpack_passages(chunk: int, ids: list, blob: bytes) -> list[tuple]:
    """``(chunk, number, id, document, first window, words)``."""
    number, doc, first, raw = unpack_arrays(blob, np.int32, np.int32, np.int32, np.uint8)
    return [(chunk, *row) for row in zip(number.tolist(), ids, doc.tolist(), first.tolist(), raw.tobytes().split(b"\n"))]


def search_shard(rows: list[tuple], window: int) -> dict[int, list[tuple[int, np.ndarray]]]:
    """Verdicts on a shard's passages: by chunk ``(number, which windows to drop)`` of those at the first place of their words.

    ``rows``: ``(chunk, number, id, document, first window, words)``.  The FM-index holds each distinct passage once, and
    the windows of all of them are searched in it.
    """
    rows = sorted(rows, key=lambda r: (r[2] is not None, r[2] if r[2] is not None else 0, r[0], r[3], r[4]))
    seen: set[bytes] = set()
    rows = [r for r in rows if not (r[5] in seen or seen.add(r[5]))]
    tokens = [r[5].split() for r in rows]
    number: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in tokens], np.int64)
    flat = [number.setdefault(w, len(number) + 1) for t in tokens for w in (*t, b"")]
    text = np.array(flat, np.int64)
    text[text == number[b""]] = 0
    index = FMIndex(text, window)
    begin = starts_of(lengths + 1)
    # where each place of the text stands in the corpus: document in order, word in document
    documents: dict[tuple, int] = {}
    doc = np.array([documents.setdefault((r[0], r[3]), len(documents)) for r in rows], np.int64)
    place = np.repeat((doc << 32) + np.array([r[4] for r in rows], np.int64) - begin, lengths + 1) + np.arange(len(text))
    n = lengths - window + 1
    starts = np.repeat(begin - starts_of(n), n) + np.arange(int(n.sum()))
    length, lo, hi = index.statistics(text, starts + window, window)
    found = np.flatnonzero(length >= window)  # every window is found, at its own place at least
    # equal windows have one interval, others have disjoint ones
    rows_from, which = np.unique(lo[found], return_inverse=True)
    rows_to = np.zeros(len(rows_from), np.int64)
    rows_to[which] = hi[found]
    least = np.minimum.reduceat(np.append(place[index.order], np.iinfo(np.int64).max),
                                np.stack((rows_from, rows_to), axis=1).reshape(-1))[::2]
    drop = np.zeros(len(starts), bool)
    drop[found] = least[which] < place[starts[found]]
    out: dict[int, list[tuple[int, np.ndarray]]] = {}
    for r, a, b in zip(rows, starts_of(n).tolist(), np.cumsum(n).tolist()):
        out.setdefault(r[0], []).append((r[1], drop[a:b]))
    return out


def remove_words(texts: list[bytes], places: np.ndarray, verdicts: dict[int, np.ndarray], window: int):
    """Per document of a chunk: words, removed words and the sha256 of the kept words joined by a space.

    ``places`` are in order; the first of a passage goes by its verdict, if it has one, the others are dropped whole.
    """
    tokens = [t.split() for t in texts]
    lengths = np.array([len(t) for t in tokens], np.int64)
    begin = starts_of(lengths)
    total = int(lengths.sum())
    doc, first, n, of = places
    at = begin[doc] + first
    judged = np.zeros(len(of), bool)
    heads, where = np.unique(of, return_index=True)
    for p, i in zip(heads.tolist(), where.tolist()):
        judged[i] = p in verdicts
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, at[~judged], 1)
    np.add.at(edge, at[~judged] + n[~judged] + window - 1, -1)
    single = [a + np.flatnonzero(verdicts[p]) for a, p in zip(at[judged].tolist(), of[judged].tolist())]
    if single:
        gone = np.concatenate(single)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + window, -1)
    gone = np.cumsum(edge)[:total] > 0
    removed = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[gone], minlength=len(lengths)).astype(np.int64)
    digests = []
    for d, t in enumerate(tokens):
        if removed[d]:
            s = int(begin[d])
            t = [w for w, g in zip(t, gone[s:s + len(t)].tolist()) if not g]
        digests.append(hashlib.sha256(b" ".join(t)).hexdigest())
    return lengths, removed, digests


def drop_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space).

    A word goes if a window that covers it starts earlier elsewhere: in a document of smaller id (null: smallest; rows of
    equal id in the order they are read), or before in the same one.  Windows are judged on the input.  Null and empty
    texts have no words; documents of fewer than ``window`` words lose none.  Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_type = dict(docs.dtypes)[id_col]
    chunks = pack(docs, id_col, text_col)
    counted = count_anchors(chunks, window, gram)
    total = F.sum("n").over(Window.partitionBy("hash"))  # a chunk has a row per hash: a hot one has a row per chunk
    repeated = counted.withColumn("total", total).where("total > 1").select("chunk", "hash", (F.col("total") > hot).alias("hot"))

    shards = max(1, chunks.count())

    def cut(key, left, right):
        out = {"chunk": [], "shard": [], "ids": [], "blob": []}
        if left.num_rows:
            chunk, ids = left["chunk"][0].as_py(), left["ids"][0].as_py()
            h = right["hash"].to_numpy().view(np.uint64)
            passages, places = cut_passages(ids, unpack(left["texts"][0].as_py()), h, h[right["hot"].to_numpy().astype(bool)],
                                            shards, window, gram)
            rows = [(s, [ids[d] for d in docs_of], blob) for s, (docs_of, blob) in pack_passages(passages).items()]
            rows.append((None, None, pack_arrays(*(p.astype(np.int32) for p in places))))
            out = {"chunk": [chunk] * len(rows), "shard": [r[0] for r in rows], "ids": [r[1] for r in rows], "blob": [r[2] for r in rows]}
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (
            pa.int64(), pa.int64(), pa.list_(left.schema.field("ids").type.value_type), pa.binary()))})

    parts = staged(chunks.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(
        cut, f"chunk long, shard long, ids array<{id_type}>, blob binary"), "passages")

    def search(key, t):
        rows = [row for c, ids, blob in zip(*(t[c].to_pylist() for c in ("chunk", "ids", "blob"))) for row in unpack_passages(c, ids, blob)]
        got = search_shard(rows, window)
        blobs = [pack_arrays(np.array([p for p, _ in v], np.int32), np.array([len(d) for _, d in v], np.int32),
                             np.concatenate([d for _, d in v]).astype(np.uint8)) for v in got.values()]
        return pa.table({"chunk": pa.array(list(got), pa.int64()), "drop": pa.array(blobs, pa.binary())})

    verdicts = parts.where("shard is not null").groupBy("shard").applyInArrow(search, "chunk long, drop binary")
    none = F.lit(None).cast("binary")
    side = (parts.where("shard is null").select("chunk", none.alias("drop"), F.col("blob").alias("places"))
            .unionByName(verdicts.select("chunk", "drop", none.alias("places"))))

    def remove(key, left, right):
        ids, n_words, n_removed, digests = [], [], [], []
        if left.num_rows:
            ids = left["ids"][0].as_py()
            at = np.stack(unpack_arrays(next(p for p in right["places"].to_pylist() if p is not None), *[np.int32] * 4)).astype(np.int64)
            verdict = {}
            for blob in right["drop"].to_pylist():
                if blob is not None:
                    number, size, drop = unpack_arrays(blob, np.int32, np.int32, np.uint8)
                    verdict.update(zip(number.tolist(), np.split(drop, np.cumsum(size)[:-1])))
            by = np.lexsort((at[1], _order(ids)[at[0]]))
            n_words, n_removed, digests = remove_words(unpack(left["texts"][0].as_py()), at[:, by], verdict, window)
        return pa.table({id_col: pa.array(ids, left.schema.field("ids").type.value_type), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    return chunks.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(
        remove, f"`{id_col}` {id_type}, n_words long, n_removed long, kept_sha256 string")


def _order(ids: list) -> np.ndarray:
    """The rank of each document of a chunk: by id (null first), then as they came."""
    rank = np.empty(len(ids), np.int64)
    rank[sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, i))] = np.arange(len(ids))
    return rank
