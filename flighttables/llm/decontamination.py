"""Benchmark decontamination with suffix arrays of the training documents.

Each task turns its documents, block by block, into a shard: the words of the block numbered by the
vocabulary of the test items (0 for a word that no item has, and between documents).  The shard's
suffix array is built by prefix doubling.  It holds the suffixes that start with a known word, ordered
up to their first unknown word, because what follows there cannot match.  Then every suffix of
every test item is binary-searched at once: the interval of the shard's suffixes that share its first k
words is narrowed word by word, which gives its longest verbatim match and all its locations.

The test items go out in blocks of bounded size, each of which is searched in every shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, carried, in_arrow, lower_ascii, starts_of

#: Bytes that separate words: the ASCII characters outside 0-9, A-Z, a-z (see ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``).
_SEPARATE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
WINDOW = 10


def item_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of letters, digits and non-ASCII characters."""
    return lower_ascii(text.encode()).translate(_SEPARATE).split() if text else []


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of the known words (> 0) of ``ids``, sorted by their first ``depth`` words up to an unknown one.

    Prefix doubling: a rank is the place of its group of ties in the order; a round ranks the members of the
    groups left by the rank of what follows.  Groups whose shared words end at an unknown one are done, and so are all at ``depth``.
    """
    n = len(ids)
    rank = np.zeros(n + 1, np.int64)
    places = np.flatnonzero(ids)
    stops = np.append(np.flatnonzero(ids == 0), n)
    order = places[np.argsort(ids[places], kind="stable")]
    room = stops[np.searchsorted(stops, order)] - order
    rank[order] = _heads(ids[order], np.arange(len(order))) + 1
    at, reach = _unsorted(rank[order], np.arange(len(order)), room >= 1), 1
    while len(at) and reach < depth:
        mine = order[at]
        key = rank[mine] * (n + 2) + rank[np.minimum(mine + reach, n)]
        by = np.argsort(key, kind="stable")
        order[at], key = mine[by], key[by]
        room[at] = room[at][by]
        rank[order[at]] = _heads(key, at) + 1
        reach *= 2
        at = at[_unsorted(rank[order[at]], np.arange(len(at)), room[at] >= reach)]
    return order


def _heads(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each entry of the sorted ``key`` the place (of ``at``) of the first entry equal to it."""
    if not len(key):
        return np.zeros(0, np.int64)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    return at[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]


def _unsorted(rank: np.ndarray, at: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """Entries of ``at`` that tie with a neighbour and go on."""
    if not len(rank):
        return at
    same = rank[1:] == rank[:-1]
    return at[(np.append(same, False) | np.insert(same, 0, False)) & goes_on]


def longest_matches(ids: np.ndarray, order: np.ndarray, query: np.ndarray, ends: np.ndarray, need: np.ndarray):
    """Longest match of every suffix of ``query`` in the shard: ``(length, lo, hi, window_lo, window_hi)``.

    The places of the longest matches are ``order[lo:hi]``, those of the first ``need[i]`` words (empty if they
    do not occur) ``order[window_lo:window_hi]``; ``ends[i]`` is where the test item of place i ends.  All
    suffixes are narrowed in step, each by two binary searches a word.
    """
    n, m = len(ids), len(query)
    padded = np.append(ids, 0)
    lo, hi = np.zeros(m, np.int64), np.full(m, len(order), np.int64)
    length, w_lo, w_hi = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    alive = np.arange(m)
    depth = 0
    while len(alive):
        want = query[alive + depth]
        low = _bound(padded, order, lo[alive], hi[alive], depth, want, n, False)
        high = _bound(padded, order, low, hi[alive], depth, want, n, True)
        ok = high > low
        alive, low, high = alive[ok], low[ok], high[ok]
        lo[alive], hi[alive] = low, high
        depth += 1
        length[alive] = depth
        full = alive[need[alive] == depth]
        w_lo[full], w_hi[full] = lo[full], hi[full]
        alive = alive[alive + depth < ends[alive]]
    lo[length == 0] = hi[length == 0] = 0
    return length, lo, hi, w_lo, w_hi


def _bound(padded, order, lo, hi, depth, want, n, upper):
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        got = padded[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, n)]
        right = open_ & ((got <= want) if upper else (got < want))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)


class TestItems:
    """A block of test items as the arrays the search needs."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.names = [k for k, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for _, ws in items for w in ws]
        lengths = np.array([len(ws) for _, ws in items], np.int64)
        starts = starts_of(lengths)
        self.query = np.array(ids, np.int64)
        self.item = np.repeat(np.arange(len(items)), lengths)
        self.ends = np.repeat(starts + lengths, lengths)
        self.depth = int(lengths.max(initial=1))
        #: words that a match at each place needs to be a window: all of a short item, none at places too near the end
        need = np.repeat(np.minimum(lengths, window), lengths)
        self.need = np.where(np.arange(len(ids)) + need <= self.ends, need, np.iinfo(np.int64).max)


def search_block(tokens: list[list[bytes]], tests: TestItems):
    """For each document: covered spans (merged, in words), names of the items found, longest match in words."""
    lengths = np.array([len(t) for t in tokens], np.int64)
    get = tests.vocabulary.get
    flat: list[int] = []
    for t in tokens:
        flat += [get(w, 0) for w in t]
        flat.append(0)
    ids = np.array(flat, np.int64)
    owner = np.repeat(np.arange(len(tokens)), lengths + 1)
    begin = starts_of(lengths + 1)
    order = suffix_array(ids, tests.depth)
    length, lo, hi, w_lo, w_hi = longest_matches(ids, order, tests.query, tests.ends, tests.need)
    spans = [[] for _ in tokens]
    items: list[set[str]] = [set() for _ in tokens]
    longest = np.zeros(len(tokens), np.int64)
    edge = np.zeros(len(ids) + 1, np.int64)
    for q in np.flatnonzero(length >= tests.need):
        at = order[w_lo[q]:w_hi[q]]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + tests.need[q], -1)
        for d in np.unique(owner[at]):
            items[d].add(tests.names[tests.item[q]])
        best = np.unique(owner[order[lo[q]:hi[q]]])
        longest[best] = np.maximum(longest[best], length[q])
    covered = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(edge) > 0).astype(np.int8)))))
    for a, b in zip(covered[::2], covered[1::2]):
        spans[owner[a]].append((int(a - begin[owner[a]]), int(b - begin[owner[a]])))
    return spans, items, longest


def read_items(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Test items with words, in blocks of at most ``block_bytes`` of text (one item at least)."""
    block, held = [], 0
    for r in benchmark.select(benchmark[item_col].cast("string").alias("k"), benchmark[text_col].alias("t")) \
            .where("k is not null").orderBy("k", "t").toLocalIterator():
        if ws := item_words(r["t"]):
            size = len(r["t"].encode())
            if block and held + size > block_bytes:
                yield block
                block, held = [], 0
            block.append((r["k"], ws))
            held += size
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 8 << 20,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       keep: bool = False) -> DataFrame:
    """Verbatim test passages in each document.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    Returns per document id, ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``spans``
    (``[start, end)`` in words, merged), ``items`` (found item ids as strings, sorted), ``longest`` (words of the
    longest verbatim match); with ``keep`` the rows of ``docs`` without a hit, all columns as they were.  Null and empty
    texts have no words; null items, items without words and items without id are no items; items of the same
    text are all found.  An empty benchmark hits nothing.  Repeated rows are judged one by one.
    """
    given = docs.columns if keep else [id_col]
    columns, text = carried(docs, given, text_col)
    rows = docs.select(*columns)
    types = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    found = "_hit_n long, _hit_spans array<struct<start:long,end:long>>, _hit_items array<string>, _hit_longest long"
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out = rows
    had = False
    for block in read_items(benchmark, item_col, text_col, block_bytes) if benchmark is not None else ():
        out = _searched(out, block, window, text, types, found, span_type, had)
        had = True
    if not had:
        out = _searched(out, [], window, text, types, found, span_type, False)
    if keep:
        return out.where(F.size("_hit_spans") == 0).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(given)])
    hit = F.aggregate("_hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("_c0").alias(id_col), F.col("_hit_n").alias("n_words"), hit.alias("n_hit"), F.col("_hit_spans").alias("spans"),
                      F.array_sort(F.array_distinct("_hit_items")).alias("items"), F.col("_hit_longest").alias("longest"))


def _searched(rows: DataFrame, block, window, text, types, found, span_type, had: bool) -> DataFrame:
    """``rows`` with what ``block`` hits; with ``had`` the columns of an earlier block are there and are merged."""
    tests = rows.sparkSession.sparkContext.broadcast(block)  # at most block_bytes of text
    n = len(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = TestItems(tests.value, window)
        for b in blocks(batches, text, 8_000_000):
            tokens = [item_words(t) for t in b.column(text).to_pylist()]
            spans, names, longest = search_block(tokens, items)
            names = [list(x) for x in names]
            if had:
                before = [b.column(k).to_pylist() for k in ("_hit_spans", "_hit_items", "_hit_longest")]
                spans = [merged([*s, *((x["start"], x["end"]) for x in o)]) for s, o in zip(spans, before[0])]
                names = [[*x, *o] for x, o in zip(names, before[1])]
                longest = np.maximum(longest, np.array(before[2], np.int64))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([len(t) for t in tokens], pa.int64()),
                 pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], span_type),
                 pa.array(names, pa.list_(pa.string())), pa.array(longest, pa.int64())],
                names=[*b.schema.names[:n], "_hit_n", "_hit_spans", "_hit_items", "_hit_longest"])

    return in_arrow(rows, run, ", ".join([*types, found]))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out

