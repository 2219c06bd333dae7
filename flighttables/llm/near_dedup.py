"""Near duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

1. Document frequencies of all five-word shingles, counted exactly over the whole table; a shingle in ``df`` documents of a table
   of ``all`` characters weighs its count in the document times ``1 + ln(1 + min(all / df, RARE)) / ln(1 + RARE)``, from 1 to 2, so that the
   similarity of copies falls little when there are thousands of them.  Only shingles in ``all / RARE`` documents or more need
   an entry in the table of weights, and there are fewer than ``RARE`` of these however large the table is.  They are
   in hash buckets of that many shingles for certain, so only the shingles of such buckets are counted one by one.
2. ICWS draws ``bands * rows`` samples per document; two documents agree in one with the probability
   of their weighted Jaccard similarity.  The draws of a shingle come from tables picked by its hash.
3. Documents that agree in all samples of a band share a bucket.  Its hub, the member that meets most others over
   all its buckets, is compared with all others.  A bucket is open while a member neither matches its hub nor is in its
   class by other links.  Open buckets of bounded size are settled in one task each: the open members against all
   members, by products of sparse blocks.  Larger ones draw new samples for sharper bands (more rows, more bands: ``LEVELS``), so
   that documents that are alike, but not enough, fall apart while links still meet; on the last level the open members of a
   larger bucket are compared with all its members block by block, a task for each two blocks.  On each level two documents of similarity 0.8 share a bucket with a
   probability of over 0.998.
4. A pair is a link if the weighted Jaccard similarity of the two texts, computed from all their shingles, is at
   least ``threshold``.  Classes are the connected components of the links, found by rounds of joins.

Exact copies (equal words) count as one document until the end, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import WordHashes, blocks, in_arrow, lower_ascii, mix64, staged, starts_of

SHINGLE = 5
THRESHOLD = 0.8
#: A shingle in fewer than one document per so many characters of the table weighs 2.
RARE = 1 << 20
#: Buckets that shingles are counted in before the frequent ones are counted one by one, and tasks whose counters are added up at once.
BUCKET_BITS, GROUP = 20, 256
#: Bands and rows of the samples on each level.
LEVELS = ((12, 3), (32, 6), (64, 10))
#: Members and characters of an open bucket that one task settles.
MEMBERS, CHARACTERS = 3_000, 8_000_000
_TABLE_BITS = 16


def _split(texts: list[str | None]) -> list[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text with A-Z lower-cased."""
    return [lower_ascii(t.encode()).split() if t else [] for t in texts]


def _every_shingle(tokens: list[list[bytes]], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, hash)`` of all shingles of each text in their order; a text of fewer than five words, but not none, is one shingle."""
    n = np.array([len(t) for t in tokens], np.int64)
    h = hashes.encode([w for t in tokens for w in t])
    wide = np.zeros(max(0, len(h)), np.uint64)
    pad = np.concatenate((h, np.zeros(SHINGLE, np.uint64)))
    place = np.arange(len(h)) - np.repeat(starts_of(n), n)
    left = np.repeat(n, n) - place
    for j in range(SHINGLE):
        wide = wide * np.uint64(0x9E3779B97F4A7C15) + np.where(left > j, pad[j:j + len(h)], np.uint64(0))
    full = (left >= SHINGLE) | (place == 0)
    return np.repeat(np.arange(len(tokens)), n)[full], mix64(wide[full])


def _counted(owner: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, hash, count)`` of the distinct pairs, sorted."""
    order = np.lexsort((wide, owner))
    owner, wide = owner[order], wide[order]
    if not len(wide):
        return owner, wide, np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (wide[1:] != wide[:-1]))))
    return owner[head], wide[head], np.diff(np.append(head, len(wide)))


def shingles(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """``(owner, hash, count)`` of the distinct shingles per text, sorted by owner and hash; sizes; keys of the words."""
    tokens = _split(texts)
    keys = [xxhash.xxh3_128_hexdigest(b" ".join(t)) for t in tokens]
    owner, h, count = _counted(*_every_shingle(tokens, hashes))
    return owner, h, count, np.bincount(owner, minlength=len(texts)), keys


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tables of r ~ Gamma(2, 1), 1 / r, ln c with c ~ Gamma(2, 1), and beta ~ U(0, 1)."""
    rng = np.random.Generator(np.random.PCG64(20240607))
    n = 1 << _TABLE_BITS
    r, c, beta = rng.gamma(2, 1, n), rng.gamma(2, 1, n), rng.random(n)
    return r.astype(np.float32), (1 / r).astype(np.float32), np.log(c).astype(np.float32), beta.astype(np.float32)


def icws(hashed: np.ndarray, weight: np.ndarray, sizes: np.ndarray, samples: int, skip: int = 0) -> np.ndarray:
    """Samples (documents x ``samples``, uint64) of documents whose elements lie one after another, each sorted by hash.

    For an element: ``t = floor(ln w / r + beta)``, ``ln a = ln c - r (t - beta + 1)``; a sample is the element of least
    ``a`` (of several the one of least hash) with its ``t``.  Every document here has an element.  ``skip`` samples are left to other levels.
    """
    r, over, ln_c, beta = _draws()
    ln_w = np.log(weight).astype(np.float32)
    starts = starts_of(sizes)
    out = np.empty((len(sizes), samples), np.uint64)
    for k in range(samples):
        seed = np.uint64((0xD6E8FEB86659FD93 * (skip + k + 1)) & 0xFFFFFFFFFFFFFFFF)
        at = ((hashed ^ seed) * np.uint64(0xFF51AFD7ED558CCD)
              >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        b = beta[at]
        t = np.floor(ln_w * over[at] + b)
        a = ln_c[at] - r[at] * (t - b + np.float32(1))
        low = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
        first = low[np.searchsorted(low, starts)]
        out[:, k] = mix64(hashed[first] ^ (t[first].astype(np.int64).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
    return out


class Weights:
    """Weight of a shingle by its hash: of the known ones (``hashes``, ascending) as given, of all others 2."""

    _BITS = 20

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        self.hashes, self.weights = hashes, weights
        self.maybe = np.zeros(1 << self._BITS, bool)  # by the first bits of a hash, whether it may be known
        self.maybe[(hashes >> np.uint64(64 - self._BITS)).astype(np.int64)] = True

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), 2.0)
        some = np.flatnonzero(self.maybe[(h >> np.uint64(64 - self._BITS)).astype(np.int64)])
        if len(some):
            at = np.searchsorted(self.hashes, h[some])
            at[at == len(self.hashes)] = 0
            known = self.hashes[at] == h[some]
            out[some[known]] = self.weights[at[known]]
        return out


def _summed(rows: DataFrame, by: list[str], finish=None) -> DataFrame:
    """Rows ``(.., part, width, counts)`` added up by ``by``: counters of unsigned integers of ``width`` bytes, or what ``finish`` makes of them."""

    def run(key, t):
        total = sum(np.frombuffer(c, f"u{w}").astype(np.int64) for w, c in zip(t["width"].to_pylist(), t["counts"].to_pylist()))
        out = finish(total) if finish else total.astype(np.uint64)
        part = t["part"][0].as_py()
        return pa.table({"part": pa.array([part]), "width": pa.array([out.dtype.itemsize], pa.int32()), "counts": pa.array([out.tobytes()], pa.binary())})

    return rows.groupBy(*by).applyInArrow(run, "part long, width int, counts binary")


def frequent_buckets(docs: DataFrame, text: str, least: float) -> np.ndarray:
    """For each of ``2 ** BUCKET_BITS`` parts of the hashes, whether ``least`` shingles or more of the table fall in it.

    A shingle in ``least`` rows is in such a bucket for certain.  Counters are added up part by part, those of ``GROUP`` tasks first.
    """
    size = 1 << BUCKET_BITS - 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, found = WordHashes(), np.zeros(1 << BUCKET_BITS, np.int64)
        for b in blocks(batches, text, 2_000_000):
            h = _every_shingle(_split(b.column(text).to_pylist()), hashes)[1]
            found += np.bincount((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(found))
        found = found.astype(np.min_scalar_type(int(found.max())))
        parts = np.flatnonzero(found.reshape(-1, size).any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts), pa.array(np.full(len(parts), TaskContext.get().partitionId() // GROUP)), pa.array(np.full(len(parts), found.itemsize, np.int32)),
             pa.array([found[p * size:(p + 1) * size].tobytes() for p in parts], pa.binary())], names=["part", "tasks", "width", "counts"])

    counts = in_arrow(docs.select(text), run, "part long, tasks long, width int, counts binary")
    marked = _summed(_summed(counts, ["part", "tasks"]), ["part"], lambda n: np.packbits(n >= least))
    out = np.zeros((1 << BUCKET_BITS) // size * size, bool)
    for r in marked.collect():  # a bit for each bucket
        out[r["part"] * size:(r["part"] + 1) * size] = np.unpackbits(np.frombuffer(r["counts"], np.uint8), count=size)
    return out


def document_frequencies(docs: DataFrame, text: str, least: float) -> DataFrame:
    """``(hash, df)`` of the shingles that occur in ``least`` rows or more.  A block of texts sends a shingle once."""
    kept = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent_buckets(docs, text, least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, maybe = WordHashes(), np.unpackbits(kept.value).astype(bool)
        for b in blocks(batches, text, 2_000_000):
            owner, h = _every_shingle(_split(b.column(text).to_pylist()), hashes)
            some = maybe[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
            h, n = np.unique(_counted(owner[some], h[some])[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])

    return in_arrow(docs.select(text), run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("df")).where(F.col("df") >= least)


def shingle_weights(docs: DataFrame, text: str, rare: int = RARE) -> Weights:
    """Weights of the shingles that occur in ``all / rare`` rows or more; ``all`` is the number of characters of the table.

    A shingle takes two characters of its row at least, but for a row of one word, so at most ``rare`` are that frequent.
    """
    characters = docs.agg(F.sum(F.length(text) + 1).alias("n")).first()["n"] or 1
    got = document_frequencies(docs, text, characters / rare).toPandas()  # at most ``rare`` rows
    h, df = got["hash"].to_numpy(np.int64).view(np.uint64), got["df"].to_numpy(np.float64)
    order = np.argsort(h)
    return Weights(h[order], 1 + np.log1p(np.minimum(characters / df[order], rare)) / np.log1p(rare))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over sum of the larger ones; elements are distinct within each side."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    small = float(np.minimum(a[1][i], b[1][j]).sum())
    whole = float(a[1].sum() + b[1].sum()) - small
    return small / whole if whole else 0.0


def signatures(docs: DataFrame, idf, id_col: str, text_col: str, bands: int, rows: int, skip: int = 0) -> DataFrame:
    """Per document: id, key of its words (null if none) and the hash of each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = WordHashes(), idf.value
        for b in blocks(batches, "text", 500_000):
            owner, h, count, sizes, keys = shingles(b.column("text").to_pylist(), hashes)
            some = np.flatnonzero(sizes)
            marks = [None] * b.num_rows
            if len(some):
                w = count * table.of(h)
                got = icws(h, w, sizes[some], bands * rows, skip).reshape(len(some), bands, rows)
                one = np.zeros((len(some), bands), np.uint64)
                for j in range(rows):
                    one = mix64(one * np.uint64(31) + got[:, :, j])
                for i, x in zip(some, one.view(np.int64).tolist()):
                    marks[i] = x
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([k if m else None for k, m in zip(keys, marks)], pa.string()),
                 pa.array(marks, pa.list_(pa.int64()))], names=["id", "key", "bands"])

    return in_arrow(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run,
                    f"id {dict(docs.dtypes)[id_col]}, key string, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """``pairs`` (a, b) with ``ok``: whether the two texts are similar."""
    rows = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, table = WordHashes(), idf.value
        for batch in blocks(batches, "ta", 500_000):
            sides = []
            for c in ("ta", "tb"):
                texts = batch.column(c).to_pylist()
                number = {t: i for i, t in enumerate(dict.fromkeys(texts))}  # a centre's text comes with each of its pairs
                _, h, count, sizes, _ = shingles(list(number), hashes)
                w = count * table.of(h)
                cut = np.cumsum(sizes)[:-1]
                of = list(zip(np.split(h, cut), np.split(w, cut)))
                sides.append([of[number[t]] for t in texts])
            ok = [weighted_jaccard(x, y) >= threshold for x, y in zip(*sides)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    types = dict(pairs.dtypes)
    return in_arrow(rows, run, f"a {types['a']}, b {types['b']}, ok boolean")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """``(bucket, id, degree)`` of ``nodes`` (id, bands) in buckets of two or more; degree: members of all the id's buckets."""
    members = nodes.select("id", F.posexplode("bands").alias("band", "mark")).select(F.xxhash64("band", "mark").alias("bucket"), "id")
    size = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = staged(members.join(size, "bucket"), "near-met")
    return staged(met.join(met.groupBy("id").agg(F.sum("n").alias("degree")), "id").select("bucket", "id", "degree"), "near-members")


def settle(found: list, open_: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links between documents ``found`` (hashes and weights of distinct shingles, shingle counts), a tree for each class.

    ``open_`` marks the documents to compare with all.  A shingle that occurs n times in a document stands for n elements
    of its weight, so the smaller weights of two documents add up to the weight of their common elements.
    """
    keys, weights = [], []
    for h, w, n in found:
        copy = np.arange(int(n.sum())) - np.repeat(starts_of(n), n)
        keys.append(mix64(np.repeat(h, n) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        weights.append(np.repeat(w, n))
    owner = np.repeat(np.arange(len(found)), [len(k) for k in keys])
    element, place, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    weight = np.zeros(len(element))
    weight[place] = np.concatenate(weights)
    whole = np.bincount(owner, weight[place], len(found))
    shared = np.flatnonzero(count > 1)
    rank = np.full(len(element), -1)
    rank[shared] = np.arange(len(shared))
    rows = np.flatnonzero(open_)
    common = np.zeros((len(rows), len(found)), np.float32)
    column = rank[place]
    by = np.argsort(column, kind="stable")
    by = by[np.searchsorted(column[by], 0):]
    for at in range(0, len(shared), 2048):
        some = by[np.searchsorted(column[by], at):np.searchsorted(column[by], at + 2048)]
        block = np.zeros((len(found), 2048), np.float32)
        block[owner[some], column[some] - at] = np.sqrt(weight[shared[column[some]]])
        common += block[rows] @ block.T
    near = common >= threshold * (whole[rows][:, None] + whole[None, :] - common) - 1e-4 * whole[rows][:, None]
    root = list(range(len(found)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    side = lambda i: (found[i][0], found[i][1] * found[i][2])
    for k, i in enumerate(rows.tolist()):
        for j in np.flatnonzero(near[k]).tolist():
            a, b = top(i), top(j)
            if a != b and weighted_jaccard(side(i), side(j)) >= threshold:
                root[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def settled(buckets: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links (a, b, ok) of open buckets ``(bucket, id, open)`` of bounded size, a task for each."""
    types = dict(texts.dtypes)

    def run(key, t):
        table, hashes = idf.value, WordHashes()
        ids = t["id"].to_pylist()
        owner, h, n, sizes, _ = shingles(t["text"].to_pylist(), hashes)
        w = table.of(h)
        cut = np.cumsum(sizes)[:-1]
        got = settle(list(zip(np.split(h, cut), np.split(w, cut), np.split(n, cut))), np.array(t["open"].to_pylist(), bool), threshold)
        pairs = [tuple(sorted((ids[i], ids[j]))) for i, j in got]
        kind = t.schema.field("id").type
        return pa.table({"a": pa.array([p[0] for p in pairs], kind), "b": pa.array([p[1] for p in pairs], kind),
                         "ok": pa.array([True] * len(pairs), pa.bool_())})

    return buckets.join(texts, "id").groupBy("bucket").applyInArrow(run, f"a {types['id']}, b {types['id']}, ok boolean")


def cells(open_: DataFrame, members: DataFrame) -> DataFrame:
    """Buckets ``(bucket, id, open)`` of bounded size that hold every open member with every member of its bucket.

    ``members`` (bucket, id, n) and ``open_`` are cut into blocks of about half a bucket's bound by a hash of the id, and each
    block of open members meets each block of members.
    """
    size = lambda rows, name: rows.groupBy("bucket").agg(F.greatest(F.ceil(2 * F.count("*") / MEMBERS), F.ceil(2 * F.sum("n") / CHARACTERS)).alias(name))
    block = lambda n: F.pmod(F.xxhash64("id", F.lit("cell")), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    opened = members.join(open_.select("bucket", "id"), ["bucket", "id"], "left_semi")
    cut = size(members, "of").join(size(opened, "open_of"), "bucket").select("bucket", F.greatest("of", F.lit(1).cast("long")).alias("of"),
                                                                            F.greatest("open_of", F.lit(1).cast("long")).alias("open_of"))
    rows = members.join(cut, "bucket").select("bucket", "id", block("of").alias("y"), every("open_of").alias("x"), F.lit(False).alias("open"))
    rows = rows.unionByName(opened.join(cut, "bucket").select("bucket", "id", block("open_of").alias("x"), every("of").alias("y"), F.lit(True).alias("open")))
    return rows.groupBy(F.xxhash64("bucket", "x", "y").alias("bucket"), "id").agg(F.max("open").alias("open"))


def links(buckets: DataFrame, texts: DataFrame, idf, threshold: float, levels=LEVELS) -> DataFrame:
    """Verified links (a, b), a < b, from the buckets of the first level; ``texts`` (id, text) has all their members."""
    done, skip, level = None, 0, 0
    members = open_ = buckets
    while True:
        centres = open_.groupBy("bucket").agg(F.min_by("id", F.struct(-F.col("degree"), "id")).alias("centre"))
        met = open_.join(centres, "bucket").where("centre <> id")
        met = staged(met.select("bucket", "id", "degree", "centre", F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")), "near-met")
        new = met.select("a", "b").distinct()
        if done is not None:
            new = new.join(done.select("a", "b"), ["a", "b"], "left_anti")
        new = staged(verify(new, texts, idf, threshold), "near-verified")
        done = new if done is None else done.unionByName(new)
        of = components(done.where("ok").select("a", "b"))
        own, hub = of.withColumnRenamed("class_id", "own"), of.select(F.col("id").alias("centre"), F.col("class_id").alias("hub"))
        open_ = staged(met.join(own, "id", "left").join(hub, "centre", "left").where(F.coalesce("own", "id") != F.coalesce("hub", "centre"))
                       .select("bucket", "id", "degree"), "near-open")
        size = (members.join(open_.select("bucket").distinct(), "bucket", "left_semi").join(texts.select("id", F.length("text").alias("n")), "id")
                .groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("chars")))
        size = staged(size.where("size > 2"), "near-sizes")  # of two members, the hub was compared with the other
        bounded = (F.col("size") <= MEMBERS) & (F.col("chars") <= CHARACTERS)
        small, large = size.where(bounded).select("bucket"), size.where(~bounded).select("bucket")
        mine = members.join(small, "bucket", "left_semi").join(open_.select("bucket", "id", F.lit(True).alias("open")), ["bucket", "id"], "left")
        done = done.unionByName(staged(settled(mine.select("bucket", "id", F.coalesce("open", F.lit(False)).alias("open")), texts, idf, threshold), "near-settled"))
        if large.isEmpty():
            return done.where("ok").select("a", "b").distinct()
        level += 1
        if level == len(levels):
            whole = members.join(large, "bucket", "left_semi").join(texts.select("id", F.length("text").alias("n")), "id")
            rest = staged(cells(open_, staged(whole.select("bucket", "id", "n"), "near-whole")), "near-cells")
            done = done.unionByName(staged(settled(rest, texts, idf, threshold), "near-settled"))
            return done.where("ok").select("a", "b").distinct()
        skip += levels[level - 1][0] * levels[level - 1][1]
        again = texts.join(members.join(large, "bucket", "left_semi").select("id").distinct(), "id", "left_semi")
        members = open_ = shared_buckets(staged(signatures(again, idf, "id", "text", *levels[level], skip), "near-marks"))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``(id, class_id)``: the least id of the connected component of every id in ``edges`` (a, b).

    Rounds of hooking each component on the least one it touches and shortening the pointers, until no
    edge joins two components.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("class_id")), "near-label")
    for _ in range(rounds):
        # pointers to the root
        while True:
            up = label.select(F.col("id").alias("class_id"), F.col("class_id").alias("upper"))
            shorter = staged(label.join(up, "class_id", "left").select("id", F.coalesce("upper", "class_id").alias("class_id"),
                             (F.coalesce("upper", "class_id") != F.col("class_id")).alias("moved")), "near-label")
            label = shorter.select("id", "class_id")
            if shorter.where("moved").isEmpty():
                break
        at = label.select(F.col("id").alias("a"), F.col("class_id").alias("ca"))
        to = label.select(F.col("id").alias("b"), F.col("class_id").alias("cb"))
        edges = staged(edges.join(at, "a").join(to, "b").where("ca <> cb")
                       .select(F.greatest("ca", "cb").alias("a"), F.least("ca", "cb").alias("b")).distinct(), "near-edges")
        if edges.isEmpty():
            return label
        hook = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("lower"))
        label = staged(label.join(hook, "id", "left").select("id", F.coalesce("lower", "class_id").alias("class_id")), "near-label")
    raise RuntimeError("components did not settle")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, levels=LEVELS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``class_id`` (least id of its class), ``n_links`` (verified links of its text).

    Texts of the same words are one node and always in one class.  Null, empty and blank texts have no shingles:
    each is a class of its own.  An id names one document; repeated rows of it share a class.  A null id
    is left out of classes (its class is null).  Other columns are ignored.
    """
    spark = docs.sparkSession
    bands, rows = levels[0]
    idf = spark.sparkContext.broadcast(shingle_weights(docs.select(docs[text_col].alias("text")), "text"))  # RARE entries at most
    marks = staged(signatures(docs, idf, id_col, text_col, bands, rows), "near-marks")
    nodes = staged(marks.where("key is not null and id is not null").groupBy("key")
                   .agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "near-nodes")
    buckets = shared_buckets(nodes)
    # a merge join at any size: the ids grow with the documents, and so does what is dealt out by them
    texts = staged(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
                   .join(buckets.select("id").distinct().hint("merge"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "near-texts")
    found = staged(links(buckets, texts, idf, threshold, levels), "near-links")
    of = components(found)
    degree = found.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    known = (nodes.select("key", "id").join(of, "id", "left").join(degree, "id", "left")
             .select("key", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return (marks.select("id", "key").join(known, "key", "left")
            .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
