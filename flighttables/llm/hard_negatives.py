"""Hard negatives of anchor vectors, with scores bounded along a spanning tree of the anchors.

1. Vectors become integers (``floor(scale * x)``), packed as chunks of ``CHUNK`` rows.  Anchors are gathered into blocks of
   about ``BLOCK`` by the signs of a few projections, so near ones lie together, and each block has its minimum spanning tree.
2. Every block meets every chunk: blocks and chunks are dealt out by (block, part of the chunks), and a task streams the
   chunks past the block.  At the root all scores of a chunk are computed.  For a child ``c`` of parent ``p`` and a
   candidate ``x`` the score lies within ``|c - p| * |x|`` of the parent's (or of the parent's bounds), so only candidates
   whose bounds overlap the window are scored again.
3. The first pass looks for the positives: candidates of the anchor's label from the lowest score kept so far on.  The second pass
   looks for the negatives: candidates of other labels in the window of a positive, ``low * positive <= 100 * negative
   <= 100 * positive``, from the lowest score kept so far on.  A task keeps the first few of each list; the lists of
   the tasks are merged by a window over (anchor[, positive]).

Scores are exact: in doubles where no sum of products can reach 2^53, in Python integers beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flighttables.llm._common import in_arrow, staged

#: Rows of a chunk and anchors of a block.
CHUNK, BLOCK = 2_048, 1_024
#: Projections whose signs put near anchors into one block.
SIGNS = 12
_LONG = 2 ** 63


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column, scale: float) -> DataFrame:
    """``(id, label, vector, anchor)`` of the rows that take part, one for each id."""
    x = rows[vector_col].cast("array<double>")
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * F.lit(float(scale)) < F.lit(float("inf")))
    part = rows.select(rows[id_col].cast("long").alias("id"), label.cast("long").alias("label"), x.alias("vector"),
                       F.coalesce(anchor, F.lit(False)).alias("anchor"))
    part = part.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", fine))
    return part.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("r")).select("id", "r.label", "r.vector", "r.anchor")


def matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * x)``; a shorter vector ends in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    return out


def _packed_row(number: int, ids, labels, m: np.ndarray, extra: bytes = b"") -> tuple:
    kind = "<i4" if not m.size or np.abs(m).max() < 2 ** 31 else "<f8"
    return number, np.asarray(ids, "<i8").tobytes(), np.asarray(labels, "<i8").tobytes(), m.shape[1], kind, m.astype(kind).tobytes(), extra


def _unpacked(ids: bytes, labels: bytes, width: int, kind: str, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(labels, "<i8"), np.frombuffer(blob, kind).reshape(len(ids), width).astype(float)


_PACKED = "number long, ids binary, labels binary, width int, kind string, rows binary, tree binary"
_PACKED_NAMES = ["number", "ids", "labels", "width", "kind", "rows", "tree"]
_PACKED_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.string(), pa.binary(), pa.binary()]


def _packed(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_PACKED_TYPES)], names=_PACKED_NAMES)


def spanning_tree(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows of ``a``: an order with parents before children, and each row's parent (-1: root) and edge length."""
    n = len(a)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    far, to, free = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    at = 0
    for k in range(n):
        order[k], parent[at], edge[at], free[at] = at, to[at], 0 if to[at] < 0 else far[at], False
        d = np.sqrt(((a - a[at]) ** 2).sum(1))
        nearer = free & (d < far)
        far[nearer], to[nearer] = d[nearer], at
        if k + 1 < n:
            at = int(np.argmin(np.where(free, far, np.inf)))
            if not free[at]:  # all distances are infinite
                at = int(np.flatnonzero(free)[0])
                to[at], far[at] = order[0], np.inf
    return order, parent, edge


def chunks_of(rows: DataFrame, scale: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                s = b.slice(at, CHUNK)
                row = _packed_row((part << 32) | seq, s.column("id").to_numpy(), s.column("label").to_numpy(), matrix(s.column("vector"), scale))
                seq += 1
                yield from _packed([row]).to_batches()

    return in_arrow(rows.select("id", "label", "vector"), run, _PACKED)


def blocks_of(anchors: DataFrame, scale: float, block: int = BLOCK) -> DataFrame:
    """Anchors in blocks of at most about two times ``block``, near ones together, each with its tree."""

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = matrix(b.column("vector"), scale)
            planes = np.random.Generator(np.random.PCG64(7)).standard_normal((SIGNS, m.shape[1]))
            mark = ((m @ planes.T) > 0) @ (1 << np.arange(SIGNS))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(mark.astype(np.int32))], names=["id", "label", "vector", "mark"])

    marked = staged(in_arrow(anchors.select("id", "label", "vector"), signs, "id long, label long, vector array<double>, mark int"), "negatives-anchors")
    held = {r["mark"]: r["n"] for r in marked.groupBy("mark").agg(F.count("*").alias("n")).collect()}  # 2^SIGNS rows at most
    place, first, room = [], 0, block
    for mark, n in sorted(held.items(), key=lambda x: x[0] ^ (x[0] >> 1)):
        parts = -(-n // block)
        if parts > 1 or n > room:
            first, room = first + (room < block), block
        place.append((mark, first, parts))
        first, room = (first + parts, block) if parts > 1 else (first, room - n)
    where = anchors.sparkSession.createDataFrame(place, "mark int, first long, parts long")
    dealt = marked.join(F.broadcast(where), "mark").withColumn("number", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")))

    def run(key, t):
        t = t.sort_by("id")
        vectors = t.column("vector").combine_chunks()
        m = matrix(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors, scale)
        order, parent, edge = spanning_tree(m)
        row = _packed_row(key[0].as_py(), t.column("id").to_numpy(), t.column("label").to_numpy(), m,
                          order.tobytes() + parent.astype(np.int64).tobytes() + edge.tobytes())
        return _packed([row])

    return dealt.groupBy("number").applyInArrow(run, _PACKED)


def _scores(x: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products: doubles that hold integers, or else longs (the nearest one)."""
    d = min(x.shape[1], len(a))
    if exact:
        return x[:, :d] @ a[:d]
    own = [int(q) for q in a[:d].tolist()]
    return np.array([_long(sum(int(p) * q for p, q in zip(row, own))) for row in x[:, :d].tolist()], np.int64)


def _long(v: int) -> int:
    return max(-_LONG, min(_LONG - 1, v))


class Windows:
    """What the anchors of a block look for, and the best found so far: per list up to ``keep`` of (score, id), the best first."""

    def __init__(self, labels: np.ndarray, same: bool, lists: list[list[tuple]], keep: int):
        self.labels, self.same, self.lists, self.keep = labels, same, lists, keep
        self.best: list[list[list[tuple]]] = [[[] for _ in own] for own in lists]

    def floors(self, i: int) -> list:
        """Lowest score that each list of anchor ``i`` still takes (None: any)."""
        out = []
        for (low, _), held in zip(self.lists[i], self.best[i]):
            full = held[-1][0] if len(held) == self.keep else None
            out.append(full if low is None else low if full is None else max(low, full))
        return out

    def offer(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        for k, ((_, high), low) in enumerate(zip(self.lists[i], self.floors(i))):
            go = np.ones(len(ids), bool) if low is None else scores >= low
            if high is not None:
                go &= scores <= high
            s, who = scores[go], ids[go]
            if not len(s):
                continue
            if len(s) > 4 * self.keep:
                least = np.partition(s, len(s) - self.keep)[len(s) - self.keep]
                who, s = who[s >= least], s[s >= least]
            found = sorted([*self.best[i][k], *((int(v), int(w)) for v, w in zip(s, who))], key=lambda r: (-r[0], r[1]))
            self.best[i][k] = found[:self.keep]


def sweep(tree: tuple, anchors: np.ndarray, anchor_ids: np.ndarray, want: Windows, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> int:
    """Offer a chunk's candidates to all anchors of a block; returns how many scores were computed."""
    order, parent, edge = tree
    norm = np.sqrt((x ** 2).sum(1))
    most = float(norm.max(initial=0)) * float(np.sqrt((anchors ** 2).sum(1)).max(initial=0))
    exact = most < 2 ** 52
    slack = 1 + 1e-9 * most  # for the rounding of norms and edges
    low, high = np.empty((len(anchors), len(x))), np.empty((len(anchors), len(x)))
    done = 0
    for i in order.tolist():
        may = ((labels == want.labels[i]) if want.same else (labels != want.labels[i])) & (ids != anchor_ids[i])
        if parent[i] < 0:
            again = np.arange(len(x))
        else:
            reach = np.nan_to_num(edge[i] * norm + slack, nan=np.inf, posinf=np.inf) if edge[i] else 0.0
            low[i], high[i] = low[parent[i]] - reach, high[parent[i]] + reach
            floors, tops = want.floors(i), [h for _, h in want.lists[i]]
            over = may
            if floors and None not in floors:
                over = over & (high[i] >= float(min(floors)))
            if tops and None not in tops:
                over = over & (np.minimum(low[i], float(_LONG)) <= float(max(tops)))
            again = np.flatnonzero(over) if floors else np.zeros(0, np.int64)
        sure = again[low[i, again] == high[i, again]] if parent[i] >= 0 and exact and not edge[i] else again[:0]
        rest = np.setdiff1d(again, sure, assume_unique=True) if len(sure) else again
        s = _scores(x if len(rest) == len(x) else x[rest], anchors[i], exact)
        done += len(rest)
        if len(rest):
            low[i, rest] = high[i, rest] = s.astype(float)
            if not exact:
                low[i, rest] -= slack
                high[i, rest] += slack
        take = may[rest]
        want.offer(i, ids[rest][take], s[take])
        if len(sure):
            take = may[sure]
            want.offer(i, ids[sure][take], low[i, sure][take])
    return done


def _meet(blocks: DataFrame, chunks: DataFrame, n_blocks: int, n_chunks: int, windows, schema: str, report) -> DataFrame:
    """Stream every chunk past every block.  ``windows(labels, extra)`` gives a block's :class:`Windows`; ``report`` its rows at the end."""
    spark = blocks.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n_chunks, -(-2 * slots // max(1, n_blocks))))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    rows = (chunks.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts))).withColumn("block", each(n_blocks))
            .select("block", "part", "number", *_PACKED_NAMES[1:], F.lit(None).cast("binary").alias("extra")))
    heads = blocks.withColumn("part", each(parts)).select(F.col("number").alias("block"), "part", F.lit(-1).cast("long").alias("number"),
                                                          *_PACKED_NAMES[1:], "extra")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                ids, labels, m = _unpacked(r["ids"], r["labels"], r["width"], r["kind"], r["rows"])
                if r["number"] < 0:
                    if state:
                        yield from report(*state[2:4])
                    n = len(ids)
                    tree = (np.frombuffer(r["tree"], np.int64, n), np.frombuffer(r["tree"], np.int64, n, 8 * n), np.frombuffer(r["tree"], float, n, 16 * n))
                    state = (tree, m, ids, windows(ids, labels, r["extra"]), r["block"])
                elif state and state[4] == r["block"]:  # else there is no block of this number
                    sweep(*state[:4], ids, labels, m)
        if state:
            yield from report(*state[2:4])

    dealt = rows.unionByName(heads).repartition("block", "part").sortWithinPartitions("block", "part", "number")
    return in_arrow(dealt, run, schema)


def hard_negatives(rows: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = 5,
                   negatives: int = 5, low: int = 80, scale: float = 256, block: int = BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` says which rows are anchors, ``label`` is their label (both over the columns of ``rows``).  A score is the inner product
    of the vectors' integers; of equal scores the smaller id is first.  An anchor's positives are its first ``positives`` other rows of
    the same label; for each, its first ``negatives`` rows of other labels with ``low * positive_score <= 100 * score <= 100 *
    positive_score``, which no score meets if the positive's is negative.

    Rows without id, label or vector, or with a null or non-finite component, take no part.  An id names one row: of rows that repeat one,
    that of the least label and vector counts.  A shorter vector ends in zeros.  Scores beyond a long are given as the nearest long.
    Other columns are ignored; without anchors, positives or negatives there are no rows.
    """
    kept = staged(usable(rows, id_col, vector_col, label, anchor, scale), "negatives-rows")
    chunks = staged(chunks_of(kept, scale), "negatives-chunks")
    blocks = staged(blocks_of(kept.where("anchor"), scale, block), "negatives-blocks")
    n_blocks, n_chunks = (blocks.agg(F.max("number")).first()[0] or 0) + 1, chunks.count()
    if blocks.isEmpty():
        return kept.select(F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(0).alias("rank"), F.col("id").alias("negative_id"),
                           F.col("id").alias("positive_score"), F.col("id").alias("negative_score")).limit(0)

    def all_same(ids, labels, extra):
        return Windows(labels, True, [[(None, None)] for _ in ids], positives)

    def found(ids, want):
        got = [(int(a), i, s) for a, lists in zip(ids, want.best) for s, i in lists[0]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in got], pa.int64()) for i in range(3)],
                                         names=["anchor_id", "positive_id", "positive_score"])

    first = _meet(blocks.withColumn("extra", F.lit(None).cast("binary")), chunks, n_blocks, n_chunks, all_same,
                  "anchor_id long, positive_id long, positive_score long", found)
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = staged(first.withColumn("nth", rank).where(F.col("nth") <= positives), "negatives-positives")

    def listed(key, t, held):
        rows = t.to_pylist()
        row = rows[0]
        own: dict[int, list] = {}
        for r in sorted(held.to_pylist(), key=lambda r: (r["anchor_id"], r["nth"])):
            own.setdefault(r["anchor_id"], []).append(f"{r['positive_id']}:{r['positive_score']}")
        ids = np.frombuffer(row["ids"], "<i8").tolist()
        said = ";".join(",".join(own.get(i, [])) for i in ids).encode()
        return _packed([tuple(row[c] for c in _PACKED_NAMES)]).append_column("extra", pa.array([said], pa.binary()))

    member = in_arrow(blocks, _members, "anchor_id long, number long")
    held = best.join(member, "anchor_id").select("number", "anchor_id", "nth", "positive_id", "positive_score")
    blocks = staged(blocks.groupBy("number").cogroup(held.groupBy("number")).applyInArrow(listed, _PACKED + ", extra binary"), "negatives-windows")

    def windows(ids, labels, extra):
        own = [[p.split(":") for p in part.split(",") if p] for part in extra.decode().split(";")]
        lists = [[(-((-low * int(s)) // 100), int(s)) for _, s in part] for part in own]
        want = Windows(labels, False, lists, negatives)
        want.positives = own
        return want

    def mined(ids, want):
        got = [(int(a), int(p), int(ps), n, s) for a, own, lists in zip(ids, want.positives, want.best)
               for (p, ps), held in zip(own, lists) for s, n in held]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in got], pa.int64()) for i in range(5)],
                                         names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    second = _meet(blocks, chunks, n_blocks, n_chunks, windows,
                   "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", mined)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return (second.withColumn("rank", rank).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for number, ids in zip(b.column("number").to_pylist(), b.column("ids").to_pylist()):
            i = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.full(len(i), number))], names=["anchor_id", "number"])
