"""Exact Jaccard join of documents by PartEnum signatures, and the components of its links.

A document's set is its distinct shingles of ``SHINGLE`` words (fewer words: the whole sequence as one).

1. Sets are dealt into bands of sizes ``l .. l * 100 / percent``: two sets of the wanted similarity lie in one band or in
   neighbouring ones.  In a band of sizes up to ``r`` such sets differ in at most ``k = 2 r (100 - percent) / (100 + percent)``
   elements.  The feature domain is cut into ``n1`` parts and each of these into ``n2``, so in one of the ``n1`` the sets differ by
   at most ``k2`` elements, and on some ``n2 - k2`` of its parts not at all.  The hash of what a set has there is a
   signature; every choice of ``n2 - k2`` parts is enumerated, for the set's own band and for the next one.  So two sets
   that are to be linked always share a signature.
2. A task packs the signatures of a chunk of documents by their leading bits.  Signatures that several sets of a chunk
   share are known to be shared and go by the side with their members, so a chunk sends any signature once, however many
   documents hold it.  Members of shared signatures come back as rows.
3. Members of a signature are compared by their counts of elements in ``CELLS`` parts of the domain: the sum of the
   differences is at most the number of differing elements, so no link is dropped.  Two members meet in many signatures
   and are compared in the least of them only.  Of what is left a member names its first few partners that are not yet
   in its component; these pairs are tested by the sets themselves, components are joined, and the next round goes on with
   the members that had more partners to name, until no pair of different components is untested.  So the copies in a
   large group are not all paired.
4. Buckets are cut into blocks of ``MEMBERS``.  First each block is compared within itself; in buckets that are still of
   several components, one block with each other one; then, where that is not enough, the members outside of the bucket's
   largest component with all others.  So the rows of a bucket grow with its members, but for those that no link joins.

Equal sets count as one until the end, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, in_arrow, lower_ascii, mix64, staged, starts_of
from flighttables.llm.chunks import pack_arrays, unpack_arrays
from flighttables.llm.near_dedup import components
from flighttables.llm.substring_dedup import hash_words

SHINGLE = 4
PERCENT = 85
#: Differing elements that a first-level part may hold, and its number of second-level parts.
K2, N2 = 1, 3
#: Parts of the domain in which elements are counted: from CELLS on, twice as many until a part has FULL elements at most.
CELLS, FULL, MOST_CELLS = 64, 4, 4_096
#: Members of a bucket that one task compares with as many others.
MEMBERS = 2_000
#: Signatures that one task of the second pass holds.
BUCKET_SIGNATURES = 1_500_000
#: Words of 64 bits in which the signatures of a member are compared at once.
SIGNATURE_WORDS = 64
#: Partners that a member names in the first round, and how many times more in each following one.
FIRST, GROWTH = 1, 8
#: Members tested with one copy of their partner's text.
TESTS = 128
#: Documents whose texts are fetched by a broadcast of their ids (of eight bytes); more are joined.
BROADCAST_IDS = 2_000_000

#: Bytes of a word up to which its polynomial hash is taken; longer ones are hashed one by one.
LONG_WORD = 256

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_INDEX_BITS, _SEQ_BITS = 20, 15


def word_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, sorted within each, and the number of each text."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw, begin, end, h, n = hash_words([lower_ascii(t.encode()) if t else b"" for t in texts])
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[begin[i]:end[i]])
    wide = np.zeros(len(h), np.uint64)
    pad = np.concatenate((h, np.zeros(SHINGLE, np.uint64)))
    place = np.arange(len(h)) - np.repeat(starts_of(n), n)
    left = np.repeat(n, n) - place
    for j in range(SHINGLE):
        wide = wide * _GOLD + np.where(left > j, pad[j:j + len(h)], np.uint64(0))
    full = (left >= SHINGLE) | (place == 0)
    wide = mix64(wide[full])
    held = np.maximum(np.minimum(n, 1), n - SHINGLE + 1)
    start = starts_of(held)
    for i, j in zip(start.tolist(), (start + held).tolist()):
        wide[i:j].sort()
    if not len(wide):
        return wide, np.zeros(len(texts), np.int64)
    new = np.concatenate(([True], wide[1:] != wide[:-1]))
    new[start[held > 0]] = True
    return wide[new], np.bincount(np.repeat(np.arange(len(texts)), held)[new], minlength=len(texts))


@lru_cache(maxsize=8)
def band_ends(percent: int, most: int) -> np.ndarray:
    """Largest size of each band, up to the band after the one that holds ``most``."""
    ends, low = [], 1
    while len(ends) < 2 or ends[-2] < most:
        ends.append(low * 100 // percent)
        low = ends[-1] + 1
    return np.array(ends, np.int64)


def signatures(elements: np.ndarray, sizes: np.ndarray, percent: int = PERCENT, k2: int = K2, n2: int = N2) -> tuple[np.ndarray, np.ndarray]:
    """``(signature, number of the set)`` of sets that lie one after another in ``elements`` (empty ones have none); ``1 <= k2 < n2``."""
    some = np.flatnonzero(sizes)
    if not len(some):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = sizes[some]
    ends = band_ends(percent, 1 << int(sizes.max()).bit_length())
    band = np.searchsorted(ends, sizes)
    owner = np.repeat(np.arange(len(some)), sizes)
    place, value = mix64(elements + _GOLD) >> np.uint64(32), mix64(elements ^ np.uint64(0xA0761D6478BD642F))
    found, of = [], []
    for instance in (band, band + 1):
        k = 2 * ends[instance] * (100 - percent) // (100 + percent)
        may = np.minimum(k, k2)  # what a first-level part may differ by
        first = -(-(k + 1) // (may + 1))
        second = np.where(may > 0, n2, 1)
        parts = first * second
        start = starts_of(parts)
        at = ((place * parts[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64) + start[owner]
        total = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(total, at, value)
        for width, choices in ((1, [(0,)]), (n2, list(combinations(range(n2), n2 - k2)))):
            mine = np.flatnonzero(second == width)
            if not len(mine):
                continue
            n = first[mine]
            who = np.repeat(mine, n)
            part = np.arange(int(n.sum())) - np.repeat(starts_of(n), n)
            held = total[(start[who] + part * width)[:, None] + np.arange(width)]
            label = mix64(instance[who].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + part.astype(np.uint64))
            for c, choice in enumerate(choices):
                found.append(mix64(held[:, list(choice)].sum(1, dtype=np.uint64) ^ mix64(label + np.uint64(c))))
                of.append(some[who])
    return np.concatenate(found), np.concatenate(of)


def counts(elements: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Elements of each set (at most 255) by part of the domain, a byte each."""
    out, at = [], 0
    for n in sizes.tolist():
        cells = CELLS
        while cells < MOST_CELLS and n > FULL * cells:
            cells *= 2
        cell = (elements[at:at + n] >> np.uint64(65 - cells.bit_length())).astype(np.int64)
        out.append(np.minimum(np.bincount(cell, minlength=cells), 255).astype(np.uint8).tobytes())
        at += n
    return out


def counted(rows: list[bytes]) -> np.ndarray:
    """Counts of several sets, brought to the fewest parts that any of them has by adding neighbours up."""
    cells = min(map(len, rows))
    if max(map(len, rows)) == cells:
        return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, cells).astype(np.int16)
    return np.stack([np.frombuffer(r, np.uint8).astype(np.int16).reshape(cells, -1).sum(1, dtype=np.int16) for r in rows])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets of distinct elements have the similarity."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _packed(docs: DataFrame, id_col: str, text_col: str, percent: int, buckets: int) -> DataFrame:
    """Rows of each chunk: its documents (kind 0), members of signatures shared within it (1), its signatures by bucket (2)."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, part = 0, TaskContext.get().partitionId()
        names = ["bucket", "kind", "chunk", "id", "key", "n", "counts", "data"]
        for b in blocks(batches, "text", 2_000_000):
            chunk = ((part << _SEQ_BITS) | seq) << _INDEX_BITS
            seq += 1
            elements, sizes = word_sets(b.column("text").to_pylist())
            cut = np.concatenate(([0], np.cumsum(sizes)))
            named = b.column("id").is_valid().to_numpy(zero_copy_only=False)
            keys = [xxhash.xxh3_128_digest(elements[cut[i]:cut[i + 1]].tobytes()) if named[i] and sizes[i] else None for i in range(b.num_rows)]
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array((np.arange(n) + chunk // (1 << _INDEX_BITS)) % buckets, pa.int32()), pa.array(np.zeros(n), pa.int32()),
                pa.array(chunk + np.arange(n)), b.column("id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array(counts(elements, sizes), pa.binary()), pa.nulls(n, pa.binary())], names=names)
            first = {}
            for i, k in enumerate(keys):
                if k is not None:
                    first.setdefault(k, i)
            keep = np.zeros(n, bool)
            keep[list(first.values())] = True
            mine = np.flatnonzero(keep)
            sig, of = signatures(elements[np.repeat(keep, sizes)], sizes[mine], percent)
            if not len(sig):
                continue
            order = np.argsort(sig, kind="stable")
            sig, of = sig[order], mine[of[order]]
            head = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            run_length = np.diff(np.append(head, len(sig)))
            many = np.repeat(run_length > 1, run_length)
            rows = []
            if many.any():
                rows.append((int(chunk >> _INDEX_BITS) % buckets, 1, pack_arrays(sig[many], of[many].astype(np.uint32))))
            sig, of = sig[head], np.where(run_length > 1, 0, of[head] + 1).astype(np.uint32)
            bucket = ((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            edge = np.searchsorted(bucket, np.arange(buckets + 1))
            rows += [(k, 2, pack_arrays(sig[edge[k]:edge[k + 1]], of[edge[k]:edge[k + 1]])) for k in np.flatnonzero(np.diff(edge)).tolist()]
            n = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([chunk] * n, pa.int64()),
                pa.nulls(n, b.column("id").type), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                pa.array([r[2] for r in rows], pa.binary())], names=names)

    return in_arrow(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run,
                    f"bucket int, kind int, chunk long, id {kind}, key binary, n long, counts binary, data binary")


def _shared(packed: DataFrame) -> DataFrame:
    """Documents (``code, id, key, n, counts``) and members (``sig, code``) of signatures that two or more sets may share."""
    kind = dict(packed.dtypes)["id"]

    def run(key, t):
        kinds = t.column("kind").to_numpy()
        rows = t.filter(pa.array(kinds == 0))
        none = np.zeros(0, np.uint64)
        sigs, codes, flags = [none], [none.astype(np.int64)], [none.astype(bool)]
        out_sig, out_code = [none], [none.astype(np.int64)]
        for which in (1, 2):
            part = t.filter(pa.array(kinds == which))
            for chunk, blob in zip(part.column("chunk").to_pylist(), part.column("data").to_pylist()):
                s, i = unpack_arrays(blob, np.uint64, np.uint32)
                if which == 1:
                    out_sig.append(s)
                    out_code.append(chunk + i.astype(np.int64))
                else:
                    sigs.append(s)
                    codes.append(chunk + i.astype(np.int64) - 1)
                    flags.append(i == 0)
        sig, code, flag = np.concatenate(sigs), np.concatenate(codes), np.concatenate(flags)
        if len(sig):
            order = np.argsort(sig, kind="stable")
            sig, code, flag = sig[order], code[order], flag[order]
            head = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            length = np.diff(np.append(head, len(sig)))
            shared = np.repeat(length > 1, length) & ~flag
            out_sig.append(sig[shared])
            out_code.append(code[shared])
        s, c = np.concatenate(out_sig).view(np.int64), np.concatenate(out_code)
        n = len(s)
        return pa.table({
            "sig": pa.chunked_array([pa.nulls(rows.num_rows, pa.int64()), pa.array(s)]),
            "code": pa.chunked_array([*rows.column("chunk").chunks, pa.array(c, pa.int64())], pa.int64()),
            **{name: pa.chunked_array([*rows.column(name).chunks, pa.nulls(n, rows.column(name).type)], rows.column(name).type)
               for name in ("id", "key", "n", "counts")}})

    return packed.groupBy("bucket").applyInArrow(run, f"sig long, code long, id {kind}, key binary, n long, counts binary")


def buckets_of(members: DataFrame, members_most: int = MEMBERS) -> DataFrame:
    """``(sig, code, blocks)``: members (``sig, code``, distinct) of signatures of two or more, and into how many blocks these are cut.

    Signatures with the same members count once.
    """
    print_of = lambda salt: F.bit_xor(F.xxhash64("code", F.lit(salt)))
    size = members.groupBy("sig").agg(F.count("*").alias("n"), print_of(1).alias("x"), print_of(2).alias("y")).where("n > 1")
    one = size.groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig", F.ceil(F.col("n") / members_most).alias("blocks"))
    return members.join(one, "sig").select("sig", "code", "blocks")


def _block(blocks: F.Column) -> F.Column:
    return F.pmod(F.xxhash64("sig", "code"), blocks)


def _cells(rows: DataFrame, own: F.Column, others: F.Column) -> DataFrame:
    """``(cell, code, side)``: members of the block ``own`` in a cell with each block of ``others``.

    ``side`` is 0 for all members of a cell that holds one block, else the members of side 1 are to be compared with those of side 2.
    """
    rows = rows.withColumn("own", own.cast("long")).withColumn("other", F.explode(others))
    return rows.select(F.struct("sig", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).alias("cell"), "code",
                       F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))


def _upto(last: F.Column, first: int = 0) -> F.Column:
    return F.sequence(F.lit(first).cast("long"), last.cast("long"))


def cells_within(buckets: DataFrame) -> DataFrame:
    """Each block of each bucket in a cell of its own."""
    return _cells(buckets, _block(F.col("blocks")), F.array(F.col("own")))


def _of_several(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets of several blocks and components; ``top`` is the bucket's largest one, ``n`` all members."""
    rows = (buckets.where("blocks > 1").join(classes, "code", "left")
            .select("sig", "code", "blocks", F.coalesce("class_id", "code").alias("class_id")))
    by = (rows.groupBy("sig", "class_id").agg(F.count("*").alias("held")).groupBy("sig")
          .agg(F.max(F.struct("held", "class_id")).alias("top"), F.sum("held").alias("n"), F.count("*").alias("several")).where("several > 1"))
    return rows.join(by.select("sig", "top", "n"), "sig")


def cells_around_first(buckets: DataFrame, classes: DataFrame, members_most: int) -> DataFrame:
    """The first block of a bucket in a cell with each other one."""
    del members_most
    return _cells(_of_several(buckets, classes), _block(F.col("blocks")),
                  F.when(F.col("own") == 0, _upto(F.col("blocks") - 1, 1)).otherwise(F.array(F.lit(0).cast("long"))))


def cells_of_rest(buckets: DataFrame, classes: DataFrame, members_most: int) -> DataFrame:
    """Blocks of the members outside of the bucket's largest component, each in a cell with each block of the bucket."""
    inside = F.col("class_id") == F.col("top.class_id")
    outer, inner = F.ceil((F.col("n") - F.col("top.held")) / members_most), F.ceil(F.col("top.held") / members_most)
    return _cells(_of_several(buckets, classes), F.when(inside, outer + _block(inner)).otherwise(_block(outer)),
                  F.when(inside, _upto(outer - 1)).otherwise(_upto(outer + inner - 1)))


def _lesser(held: pa.ListArray, sig: int) -> list[np.ndarray]:
    """For each member of a signature the lesser signatures of its list ``held``, as bits over those that several members have.

    The bits come in blocks (a row a member, ``SIGNATURE_WORDS`` words at most), the most common signatures first.
    """
    value = held.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(held)), held.value_lengths().to_numpy(zero_copy_only=False))
    value, owner = value[value < sig], owner[value < sig]
    _, at, n = np.unique(value, return_inverse=True, return_counts=True)
    by = np.argsort(-n, kind="stable")
    place = np.empty(len(n), np.int64)
    place[by] = np.arange(len(n))
    at, several = place[at], int((n > 1).sum())
    out = []
    for low in range(0, several, 64 * SIGNATURE_WORDS):
        high = min(several, low + 64 * SIGNATURE_WORDS)
        mine = (at >= low) & (at < high)
        bits = np.zeros((len(held), -(-(high - low) // 64)), np.uint64)
        np.bitwise_or.at(bits, (owner[mine], (at[mine] - low) // 64), np.uint64(1) << ((at[mine] - low) % 64).astype(np.uint64))
        out.append(bits)
    return out


def _meet_first(a: np.ndarray, b: np.ndarray, lesser: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs of members that have no lesser signature in common."""
    for bits in lesser:
        step = 1 + 1_600_000 // bits.shape[1]
        alone = [np.zeros(0, bool)]
        for at in range(0, len(a), step):
            alone.append(~(bits[a[at:at + step]] & bits[b[at:at + step]]).any(1))
        alone = np.concatenate(alone)
        a, b = a[alone], b[alone]
    return a, b


def _near(groups: Iterator[pa.Table], percent: int, most: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Pairs (code, smaller code) of each group that may be linked and are of different components, at most ``most`` for a code,
    and the rows of the members of those that are left.

    A pair belongs to the least signature that both have (``sigs``); other groups leave it out.
    """
    for t in groups:
        order = np.argsort(t.column("n").to_numpy(), kind="stable")
        n, code, own, side = (t.column(c).to_numpy()[order] for c in ("n", "code", "class_id", "side"))
        count = counted(t.column("counts").to_pylist())[order]
        tested = {(int(code[i]), p) for i, ps in enumerate(t.column("tested").take(pa.array(order)).to_pylist()) if ps for p in ps}
        lesser = _lesser(t.column("sigs").combine_chunks().take(pa.array(order)), t.column("cell").chunk(0).field("sig")[0].as_py())
        reach = np.searchsorted(n * percent, n * 100, "right")  # partners of the i-th are those after it, up to here
        width = np.maximum(reach - np.arange(len(n)) - 1, 0)
        found = []
        at = 0
        while at < len(n):
            stop = max(at + 1, int(np.searchsorted(np.cumsum(width[at:]), 100_000, "right")) + at)
            a = np.repeat(np.arange(at, stop), width[at:stop])
            b = a + 1 + np.arange(len(a)) - np.repeat(starts_of(width[at:stop]), width[at:stop])
            at = stop
            go = (own[a] != own[b]) & (code[a] != code[b]) & ((side[a] == 0) | (side[a] != side[b]))
            a, b = _meet_first(a[go], b[go], lesser)
            step = 1 + 6_400_000 // count.shape[1]
            for lo in range(0, len(a), step):
                x, y = a[lo:lo + step], b[lo:lo + step]
                apart = np.abs(count[x] - count[y]).sum(1, dtype=np.int64)
                ok = apart * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
                x, y = code[x[ok]], code[y[ok]]
                found.append(np.stack((np.maximum(x, y), np.minimum(x, y)), 1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        if tested and len(pairs):
            pairs = pairs[[(u, v) not in tested for u, v in pairs.tolist()]]
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        u = pairs[:, 0]
        head = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))) if len(u) else np.zeros(0, np.int64)
        rank = np.arange(len(u)) - np.repeat(head, np.diff(np.append(head, len(u))))
        yield t, pairs[rank < most], np.flatnonzero(np.isin(t.column("code").to_numpy(), pairs[rank >= most]))


def _runs(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.Table]:
    """Tables of equal values of the struct column ``name`` from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        fields = b.column(name).flatten()
        values = np.stack([f.to_numpy(zero_copy_only=False) for f in fields], 1)
        edge = np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1
        if last is not None and (values[0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for e in edge.tolist():
            held.append(b.slice(start, e - start))
            yield pa.Table.from_batches(held)
            held, start = [], e
        held.append(b.slice(start))
        last = values[-1]
    if held:
        yield pa.Table.from_batches(held)


def candidates(cells: DataFrame, nodes: DataFrame, classes: DataFrame, tested: DataFrame, percent: int, most: int) -> DataFrame:
    """``(cell, u, v, side)``: partners named in each cell; a pair is named in one cell only.  ``nodes`` have the signatures (``sigs``) of each code.

    Members of the pairs that were not named, as there were more than ``most``, come back with their ``side`` and without ``v``.
    """
    failed = tested.where("not ok").groupBy(F.col("u").alias("code")).agg(F.collect_list("v").alias("tested"))  # those that u has named
    rows = (cells.join(nodes.select("code", "n", "counts", "sigs"), "code").join(classes, "code", "left").join(failed, "code", "left")
            .select("cell", "code", "side", "n", "counts", "sigs", F.coalesce("class_id", "code").alias("class_id"), "tested"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, pairs, left in _near(_runs(batches, "cell"), percent, most):
            n = len(pairs) + len(left)
            if n:
                cell = t.column("cell").slice(0, 1).combine_chunks()
                cell = cell.chunk(0) if isinstance(cell, pa.ChunkedArray) else cell
                code, side = (t.column(c).to_numpy()[left] for c in ("code", "side"))
                yield pa.RecordBatch.from_arrays(
                    [cell.take(pa.array(np.zeros(n, np.int64))), pa.array(np.concatenate((pairs[:, 0], code))),
                     pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(len(left), pa.int64())]),
                     pa.concat_arrays([pa.nulls(len(pairs), pa.int32()), pa.array(side, pa.int32())])], names=["cell", "u", "v", "side"])

    return in_arrow(rows.repartition("cell").sortWithinPartitions("cell"), run, "cell struct<sig: long, low: long, high: long>, u long, v long, side int")


def test_pairs(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``(u, v, ok)``: pairs by their sets.  A ``v`` that many name is sent once for each ``TESTS`` of them."""
    often = pairs.groupBy("v").agg(F.ceil(F.count("*") / TESTS).alias("parts"))
    dealt = pairs.join(often, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("parts")).alias("part"))
    dealt = staged(dealt, "jaccard-dealt")
    tests = dealt.join(texts.select(F.col("code").alias("u"), "text"), "u").select("v", "part", "u", "text")
    heads = (dealt.select("v", "part").distinct().join(texts.select(F.col("code").alias("v"), "text"), "v")
             .select("v", "part", F.lit(None).cast("long").alias("u"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        against = np.zeros(0, np.uint64)
        for b in blocks(batches, "text", 1_000_000):
            elements, sizes = word_sets(b.column("text").to_pylist())
            cut = np.concatenate(([0], np.cumsum(sizes)))
            out = []
            for i, (u, v) in enumerate(zip(b.column("u").to_pylist(), b.column("v").to_pylist())):
                mine = elements[cut[i]:cut[i + 1]]
                if u is None:
                    against = mine.copy()
                else:
                    out.append((u, v, linked(mine, against, percent)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], pa.bool_())], names=["u", "v", "ok"])

    rows = tests.unionByName(heads).repartition("v", "part").sortWithinPartitions("v", "part", F.col("u").asc_nulls_first())
    return in_arrow(rows, run, "u long, v long, ok boolean")


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(code, text)`` of the nodes in ``wanted`` (code), from the documents' table."""
    want = staged(nodes.join(wanted, "code", "left_semi").select("id", "key", "code"), "jaccard-wanted")
    ids = want.select("id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(ids, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", 2_000_000):
            elements, sizes = word_sets(b.column("text").to_pylist())
            cut = np.concatenate(([0], np.cumsum(sizes)))
            keys = [xxhash.xxh3_128_digest(elements[cut[i]:cut[i + 1]].tobytes()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(keys, pa.binary()), b.column("text")], names=["id", "key", "text"])

    found = in_arrow(rows, run, f"id {dict(docs.dtypes)[id_col]}, key binary, text string")
    return found.join(want, ["id", "key"]).groupBy("code").agg(F.min("text").alias("text"))  # equal sets: any of the texts will do


def jaccard_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                       members_most: int = MEMBERS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (least id reachable by links, its own included), ``n_links_tested``.

    Two documents link when ``100 * common >= percent * all`` of their shingles.  ``n_links_tested`` counts the links
    of its set to different sets that were tested; pairs that are in one component by other links are not.  Null, empty and blank texts have
    no shingles and no links.  Each row is a document: rows that repeat an id are compared like others.  A row without id is
    linked with nothing and has no component.  Other columns are ignored; an empty table gives no rows.
    """
    chars = docs.select(F.sum(F.length(docs[text_col]))).first()[0] or 0
    packed = _packed(docs, id_col, text_col, percent, int(chars // (12 * BUCKET_SIGNATURES)) + 1)
    found = staged(_shared(packed), "jaccard-members")
    rows = found.where("sig is null").select("code", "id", "key", "n", "counts")
    nodes = staged(rows.where("key is not null").groupBy("key")
                   .agg(F.min("code").alias("code"), F.min("id").alias("id"), F.first("n").alias("n"), F.first("counts").alias("counts")), "jaccard-nodes")
    of = rows.where("key is not null").select("key", F.col("code").alias("row")).join(nodes.select("key", "code"), "key").where("row <> code")
    members = (found.where("sig is not null").select("sig", F.col("code").alias("row")).join(of.select("row", "code"), "row", "left")
               .select("sig", F.coalesce("code", "row").alias("code")).distinct())
    buckets = staged(buckets_of(staged(members, "jaccard-shared"), members_most), "jaccard-buckets")

    # The signatures of a set that others share: bounded by the signatures of one set.
    held = buckets.groupBy("code").agg(F.sort_array(F.collect_list("sig")).alias("sigs"))
    compared = staged(nodes.select("code", "n", "counts").join(held, "code"), "jaccard-compared")

    classes = nodes.select("code", F.col("code").alias("class_id")).limit(0)
    tested = nodes.select(F.col("code").alias("u"), F.col("code").alias("v"), F.lit(True).alias("ok")).limit(0)
    texts = None
    for part in (None, cells_around_first, cells_of_rest):
        if part is None:
            cells = cells_within(buckets)
        elif buckets.where("blocks > 1").isEmpty():
            break
        else:
            cells = staged(part(buckets, classes, members_most), "jaccard-cells")
        most = FIRST
        while not cells.isEmpty():
            found = staged(candidates(cells, compared, classes, tested, percent, most), "jaccard-found")
            named = staged(found.where("v is not null").select("u", "v"), "jaccard-named")
            if named.isEmpty():
                break
            both = named.select(F.explode(F.array("u", "v")).alias("code")).distinct()
            if texts is not None:
                both = both.join(texts.select("code"), "code", "left_anti")
            more = staged(_texts(docs, nodes, both, id_col, text_col), "jaccard-texts")
            texts = more if texts is None else texts.unionByName(more)
            done = staged(test_pairs(named, texts, percent), "jaccard-tested")
            tested = tested.unionByName(done)
            classes = components(tested.where("ok").select(F.col("u").alias("a"), F.col("v").alias("b"))).withColumnRenamed("id", "code")
            cells = found.where("v is null").select("cell", F.col("u").alias("code"), "side")  # of pairs that were not named
            most *= GROWTH

    degree = tested.where("ok").select(F.explode(F.array("u", "v")).alias("code")).groupBy("code").agg(F.count("*").alias("n_links"))
    label = nodes.join(classes, "code", "left").select("key", "code", "id", F.coalesce("class_id", "code").alias("class_id")).join(degree, "code", "left")
    least = label.groupBy("class_id").agg(F.min("id").alias("component_id"))
    label = label.join(least, "class_id").select("key", "component_id", "n_links")
    return (rows.select("id", "n", "key").join(label, "key", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links_tested")))
