"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

``P(w | context) = P(class of w | context) * P(w | class)``.  The first factor is a softmax over classes of the summed
weights of hashed features of the context: the word before, the two words before, the word before that with a
skip, and the last bytes of both.  The second goes down a binary tree over the words of the class, told apart by the bits of their
hashes: each node is a logistic decision whose log odds are those of the counts below it plus the weights of the same features, hashed
with the node.  The words of a leaf share it by their smoothed counts.  With all weights 0 the factor is the smoothed relative count within
the class.  Classes follow from the counts alone: frequent words
by bands of equal mass, the others by their last bytes; each class of rare words has one place for all its unseen
words.  So the probabilities of all words, with one for the unseen words of a class, sum to 1.

The trees' depth goes by the number of distinct words (a tree has about a fourth as many leaves, up to ``MAX_DEPTH`` levels), and their table of weights by the number of
tokens (``TREE_BITS``); both are as large as what tasks can hold at most, and beyond that words share leaves and features share weights.

The corpus is encoded once into chunks (word numbers of each chunk and its vocabulary); the vocabularies meet in one
shuffle that counts every word over all training documents and returns to each chunk the counts of its own words.
Training is one pass over all training documents in ``steps`` parts: in each, the tasks add up the gradients of their
part, these sums are added by feature in a shuffle, and the weights are updated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, crc32_text, in_arrow, mix64, ship_package, staged, starts_of
from flighttables.llm.chunks import pack_arrays, unpack_arrays

#: Documents whose crc32 of the id as text modulo FOLDS is HELD_OUT are not learned from.
FOLDS, HELD_OUT = 7, 2
BITS = 14
#: Least and greatest size (in bits) of the table of the trees' weights; greatest depth of the trees.
TREE_BITS, MAX_DEPTH = (16, 20), 13
FREQUENT, RARE = 16, 16
CLASSES = FREQUENT + RARE
STEPS = 4
SHRINK = 200.0
_END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds a line feed
_BEGIN = np.uint64(0x5851F42D4C957F2D)
_BLOCK, _TREE_BLOCK = 1 << 10, 1 << 14
_NODE, _PLACE = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)  # odd factors that spread nodes and places


def encode_chunks(docs: DataFrame, id_col: str, text_col: str, chunk_chars: int = 6_000_000) -> DataFrame:
    """``chunk``, ``ids``, and the chunk's words: ``vocabulary`` (hashes, shapes) and ``tokens`` (numbers, sizes, held out).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, told apart by 64-bit hashes; each document ends with one end token.
    """
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        number: dict[bytes, int] = {}
        ids, tokens, sizes, held = [], [], [], 0

        def close():
            nonlocal seq, number, ids, tokens, sizes, held
            names = pa.concat_arrays(ids)
            words = list(number)
            hashed = np.array([_END if w == b"\n" else xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
            shape = np.array([xxhash.xxh3_64_intdigest(w[-2:]) % RARE for w in words], np.uint8)
            out = np.array([i is not None and crc32_text(i) % FOLDS == HELD_OUT for i in names.to_pylist()], np.uint8)
            row = pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) | seq], pa.int64()), pa.ListArray.from_arrays([0, len(names)], names),
                 pa.array([pack_arrays(hashed, shape)], pa.binary()),
                 pa.array([pack_arrays(np.concatenate(tokens), np.array(sizes, np.int32), out)], pa.binary())],
                names=["chunk", "ids", "vocabulary", "tokens"])
            seq, number, ids, tokens, sizes, held = seq + 1, {}, [], [], [], 0
            return row

        for b in blocks(batches, "text", chunk_chars // 4):
            ids.append(b.column("id"))
            for t in b.column("text").to_pylist():
                raw = (t or "").encode().lower().split()
                raw.append(b"\n")
                tokens.append(np.array([number.setdefault(w, len(number)) for w in raw], np.int32))
                sizes.append(len(raw))
                held += len(t or "") + 1
            if held >= chunk_chars * 3 // 4:
                yield close()
        if sizes:
            yield close()

    return staged(in_arrow(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), run,
                           f"chunk long, ids array<{id_type}>, vocabulary binary, tokens binary"), "lm-chunks")


def count_words(chunks: DataFrame) -> DataFrame:
    """``(chunk, hash, shape, total, first)``: each chunk's words with their count in all training documents.

    ``first`` marks one row of each word.  A chunk sends a word once, so the most frequent word has a row per chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashed, shape = unpack_arrays(batch.column("vocabulary")[i].as_py(), np.uint64, np.uint8)
                tokens, sizes, out = unpack_arrays(batch.column("tokens")[i].as_py(), np.int32, np.int32, np.uint8)
                n = np.bincount(tokens[np.repeat(out == 0, sizes)], minlength=len(hashed))
                for at in range(0, len(hashed), 100_000):
                    s = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hashed[s]), batch.column("chunk")[i].as_py())), pa.array(hashed[s].view(np.int64)),
                         pa.array(shape[s].astype(np.int8)), pa.array(n[s])], names=["chunk", "hash", "shape", "n"])

    by = Window.partitionBy("hash")
    rows = in_arrow(chunks.select("chunk", "vocabulary", "tokens"), run, "chunk long, hash long, shape byte, n long")
    return staged(rows.select("chunk", "hash", "shape", F.sum("n").over(by).alias("total"),
                              (F.min("chunk").over(by) == F.col("chunk")).alias("first")), "lm-words")


@dataclass
class Classes:
    """Which class a word has, and what each class weighs.

    Words counted ``bounds[0]`` times or more are frequent: class k has those counted from ``bounds[-1 - k]`` on and fewer
    than the class before.  ``mass`` is the sum of ``count + 1`` over the words of a class, its unseen word included, and ``leaves`` the same
    by class and leaf of its tree.  The leaf of a word is the first ``depth`` bits of its hash; unseen words are in the first one.  ``odds`` has
    the log odds of the right child of each node, level by level (infinite where one child has no word).
    """

    bounds: np.ndarray
    mass: np.ndarray
    tokens: int
    types: int
    depth: int = 0
    leaves: np.ndarray | None = None
    odds: np.ndarray | None = None

    def label(self, total: F.Column, shape: F.Column) -> F.Column:
        """:meth:`of` as a column."""
        above = sum((F.when(total >= int(b), 1).otherwise(0) for b in self.bounds), F.lit(0))
        return F.when(above > 0, len(self.bounds) - above).otherwise(FREQUENT + shape.cast("int"))

    def grow(self, words: DataFrame) -> None:
        """Fill the leaves of the trees: one row for each leaf that has a word, ``CLASSES << MAX_DEPTH`` at most."""
        self.depth = min(max(1, (self.types // 8).bit_length()), MAX_DEPTH)
        self.leaves = np.zeros((CLASSES, 1 << self.depth))
        got = (words.where("first and total > 0").groupBy(self.label(F.col("total"), F.col("shape")).alias("label"),
                                                          F.shiftrightunsigned("hash", 64 - self.depth).cast("int").alias("leaf"))
               .agg(F.sum(F.col("total") + 1).alias("mass")).toArrow())
        self.leaves[got["label"].to_numpy(), got["leaf"].to_numpy()] = got["mass"].to_numpy()
        self.leaves[FREQUENT:, 0] += 1  # the unseen
        below, odds = self.leaves, []
        with np.errstate(divide="ignore", invalid="ignore"):
            for _ in range(self.depth):
                left, right = below[:, ::2], below[:, 1::2]
                odds.append((np.log(right) - np.log(left)).ravel())
                below = left + right
        self.odds = np.nan_to_num(np.concatenate(odds[::-1]), nan=0.0, posinf=np.inf, neginf=-np.inf).astype(np.float32)

    def of(self, count: np.ndarray, shape: np.ndarray) -> np.ndarray:
        above = np.searchsorted(self.bounds, count, "right")
        return np.where(above > 0, len(self.bounds) - above, FREQUENT + shape.astype(np.int64))


def _binned(count: F.Column) -> F.Column:
    """A count of 256 or more rounded down to a 32nd of its power of two, so that there are few different ones."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(count.cast("double"))) - 5)
    return F.when(count < 256, count).otherwise((F.floor(count / step) * step).cast("long"))


def make_classes(words: DataFrame) -> Classes:
    rows = (words.where("first and total > 0").groupBy(_binned(F.col("total")).alias("c"), "shape")
            .agg(F.count("*").alias("types"), F.sum("total").alias("tokens")).collect())  # bounded by the bins
    tokens, types = sum(r["tokens"] for r in rows), sum(r["types"] for r in rows)
    by_count: dict[int, int] = {}
    for r in rows:
        by_count[r["c"]] = by_count.get(r["c"], 0) + r["tokens"] + r["types"]
    bounds, held, want = [], 0, (tokens + types) / 2 / FREQUENT
    for c in sorted(by_count, reverse=True):
        if len(bounds) == FREQUENT or c < 2:
            break
        held += by_count[c]
        if held >= want:
            bounds.append(c)
            held = 0
    made = Classes(np.array(sorted(bounds), np.int64), np.zeros(CLASSES), tokens, types)
    for r in rows:
        made.mass[made.of(np.array([r["c"]]), np.array([r["shape"]]))[0]] += r["tokens"] + r["types"]
    made.mass[FREQUENT:] += 1  # the unseen
    made.grow(words)
    return made


def with_counts(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """``chunks`` with ``counts``: the training counts of the words of the chunk, in the order of its vocabulary."""

    def join(key, left, right):
        out = {"chunk": [], "ids": [], "vocabulary": [], "tokens": []}
        if left.num_rows:
            hashed, shape = unpack_arrays(left["vocabulary"][0].as_py(), np.uint64, np.uint8)
            given, total = right["hash"].to_numpy().view(np.uint64), right["total"].to_numpy()
            by = np.argsort(given)
            counts = total[by][np.searchsorted(given[by], hashed)]
            out = {"chunk": left["chunk"].to_pylist(), "ids": left["ids"].to_pylist(),
                   "vocabulary": [pack_arrays((hashed >> np.uint64(32)).astype(np.uint32), shape, counts.astype(np.int64))],
                   "tokens": left["tokens"].to_pylist()}
        return pa.table({c: pa.array(v, left.schema.field(c).type) for c, v in out.items()})

    ids = chunks.schema["ids"].dataType.simpleString()
    return staged(chunks.groupBy("chunk").cogroup(words.select("chunk", "hash", "total").groupBy("chunk")).applyInArrow(
        join, f"chunk long, ids {ids}, vocabulary binary, tokens binary"), "lm-counted")


class Chunk:
    """The documents of a chunk as arrays over their tokens."""

    def __init__(self, vocabulary: bytes, tokens: bytes, classes: Classes):
        hashed, shape, count = unpack_arrays(vocabulary, np.uint32, np.uint8, np.int64)
        self.tokens, self.sizes, out = unpack_arrays(tokens, np.int32, np.int32, np.uint8)
        self.held_out = out > 0
        self.count = count
        self.label = classes.of(count, shape)
        spread = mix64(hashed.astype(np.uint64))
        self.one = (spread >> np.uint64(64 - BITS)).astype(np.int64)
        self.spread, self.shape = spread, shape.astype(np.uint64)
        self.leaf = np.where(count > 0, hashed >> np.uint32(32 - classes.depth), 0).astype(np.int64)
        self.in_leaf = np.log10((count + 1.0) / classes.leaves[self.label, self.leaf])  # P(w | class, leaf)

    def features(self, where: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The features of the contexts of the tokens at ``where``, as 64-bit hashes; ``starts`` is where their documents begin."""
        w1, w2 = self.tokens[np.maximum(where - 1, 0)], self.tokens[np.maximum(where - 2, 0)]
        has1, has2 = where > starts, where > starts + 1
        first, second = np.where(has1, self.spread[w1], _BEGIN), np.where(has2, self.spread[w2], _BEGIN)
        shapes = np.where(has1, self.shape[w1], np.uint64(RARE)) * np.uint64(RARE + 1) + np.where(has2, self.shape[w2], np.uint64(RARE))
        return np.stack((mix64(first ^ np.uint64(1)), mix64(first * np.uint64(3) + second), mix64(second ^ np.uint64(2)), mix64(shapes + _BEGIN)))


@dataclass
class Model:
    """Weights of the features for the classes (``weights``, with a ``bias`` a class) and for the nodes of the trees (``tree``)."""

    classes: Classes
    weights: np.ndarray
    bias: np.ndarray
    tree: np.ndarray


def _buckets(features: np.ndarray) -> np.ndarray:
    return (features >> np.uint64(64 - BITS)).astype(np.int64)


def class_probabilities(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    buckets = _buckets(features)
    z = weights[buckets[0]]
    for f in buckets[1:]:
        z += weights[f]
    z += bias
    np.exp(z, out=z)  # far from overflow: four weights of at most 8 and a logarithm of a share
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def decisions(model: Model, features: np.ndarray, label: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray | slice, ...]]:
    """The paths to the leaves, level by level: tokens with a choice there (a slice: all), the places of their weights, whether they go
    right, its log odds."""
    known, shift = model.classes, np.uint32(33 - len(model.tree).bit_length())
    features = (features >> np.uint64(32)).astype(np.uint32)
    for d in range(known.depth):
        node = CLASSES * ((1 << d) - 1) + (label << d) + (leaf >> (known.depth - d))
        z = known.odds[node]
        some = np.flatnonzero(np.isfinite(z))
        if not len(some):
            continue
        if len(some) == len(z):
            some, mine, turn = slice(None), features, leaf
        else:
            mine, node, turn, z = features.take(some, 1), node.take(some), leaf.take(some), z.take(some)
        places = mine ^ (node.astype(np.uint32) * _NODE)
        places *= _PLACE
        places >>= shift
        places = places.astype(np.int64)
        for p in places:
            z += model.tree.take(p)
        yield some, places, (turn >> (known.depth - 1 - d)) & 1 > 0, z


def log_leaf(model: Model, features: np.ndarray, label: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """log10 P(leaf | class, context)."""
    out = np.zeros(len(label))
    for some, _, right, z in decisions(model, features, label, leaf):
        np.negative(z, out=z, where=right)
        np.exp(z, out=z)
        out[some] -= np.log1p(z, out=z)
    return out / np.log(10.0)


def gradients(chunk: Chunk, chosen: np.ndarray, model: Model, into: np.ndarray, tree: np.ndarray, batch: int = 16_384) -> None:
    """Add the gradients of the chosen documents' tokens to ``into`` (a row of gradients for each class, and one of occurrences) and
    ``tree`` (a row of gradients and one of curvatures)."""
    starts = np.repeat(starts_of(chunk.sizes), chunk.sizes)
    where = np.flatnonzero(np.repeat(chosen, chunk.sizes))
    places, slopes, curves, held = [], [], [], 0
    for at in range(0, len(where), batch):
        some = where[at:at + batch]
        f = chunk.features(some, starts[some])
        words = chunk.tokens[some]
        err = class_probabilities(model.weights, model.bias, f)
        np.negative(err, out=err)
        err[np.arange(len(some)), chunk.label[words]] += 1
        buckets = _buckets(f)
        for k, e in enumerate(np.ascontiguousarray(err.T, np.float64)):
            into[k] += sum(np.bincount(b, e, into.shape[1]) for b in buckets)
        into[CLASSES] += np.bincount(buckets.ravel(), minlength=into.shape[1])
        for _, p, right, z in decisions(model, f, chunk.label[words], chunk.leaf[words]):
            share = 1 / (1 + np.exp(-z))
            places.append(p)
            slopes.append(right - share)
            curves.append(share * (1 - share))
            held += p.size
        if places and (held > 1 << 20 or at + batch >= len(where)):
            slope, curve = np.concatenate(slopes).astype(np.float64), np.concatenate(curves).astype(np.float64)
            for p in np.concatenate(places, axis=1):
                tree[0] += np.bincount(p, slope, tree.shape[1])
                tree[1] += np.bincount(p, curve, tree.shape[1])
            places, slopes, curves, held = [], [], [], 0


def _short(x: np.ndarray) -> bytes:
    """The upper halves of floats, rounded: sums of a task lose less than half a percent each."""
    return ((np.ascontiguousarray(x, np.float32).view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16)).astype(np.uint16).tobytes()


def _long(raw: bytes) -> np.ndarray:
    return (np.frombuffer(raw, np.uint16).astype(np.uint32) << np.uint32(16)).view(np.float32)


def train(counted: DataFrame, classes: Classes, steps: int = STEPS, rate: float = 0.35, shrink: float = SHRINK) -> Model:
    """Weights of the features and bias of the classes, by ``steps`` distributed updates over all training documents.

    An update moves a feature's weights by its gradient over its occurrences, or in the trees over its curvature, with ``shrink`` occurrences
    added that pull to 0.
    """
    spark = counted.sparkSession
    prior = np.maximum(classes.mass, 1e-3) / max(classes.mass.sum(), 1e-3)
    bias = np.log(prior).astype(np.float32)
    curve = prior * (1 - prior) + 1e-4  # of the loss, per occurrence
    bits = min(max(TREE_BITS[0], classes.tokens.bit_length() - 9), TREE_BITS[1])
    model = Model(classes, np.zeros((1 << BITS, CLASSES), np.float32), bias, np.zeros(1 << bits, np.float32))
    weights, tree = model.weights, model.tree
    for step in range(steps):
        shared = spark.sparkContext.broadcast(model)  # 2^BITS x classes and 2^bits floats, and the leaves

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value  # noqa: B023
            total, nodes = np.zeros((CLASSES + 1, 1 << BITS), np.float32), np.zeros((2, 1 << bits), np.float32)
            for batch in batches:
                for i in range(batch.num_rows):
                    chunk = Chunk(batch.column("vocabulary")[i].as_py(), batch.column("tokens")[i].as_py(), held.classes)
                    turn = (np.arange(len(chunk.sizes)) + batch.column("chunk")[i].as_py()) % steps == step  # noqa: B023
                    gradients(chunk, turn & ~chunk.held_out, held, total, nodes)
            found = [(k, total[:, k:k + _BLOCK]) for k in range(0, 1 << BITS, _BLOCK) if total[CLASSES, k:k + _BLOCK].any()]
            found += [((1 << BITS) + k, nodes[:, k:k + _TREE_BLOCK]) for k in range(0, 1 << bits, _TREE_BLOCK) if nodes[1, k:k + _TREE_BLOCK].any()]
            for k, g in found:
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([_short(g)], pa.binary())], names=["block", "g"])

        def add(key, t):
            total = sum(_long(g.as_py()).astype(np.float64) for g in t["g"])
            return pa.table({"block": t["block"].slice(0, 1).cast(pa.int32()), "g": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

        sums = in_arrow(counted.select("chunk", "vocabulary", "tokens"), run, "block int, g binary") \
            .groupBy("block").applyInArrow(add, "block int, g binary").collect()  # as large as the model
        for r in sums:
            k, g = r["block"], np.frombuffer(r["g"], np.float32)
            if k < 1 << BITS:
                g = g.reshape(-1, _BLOCK).T
                move = rate * g[:, :CLASSES] / ((g[:, CLASSES:] + shrink) * curve)
                weights[k:k + _BLOCK] += np.clip(move, -2, 2).astype(np.float32)
            else:
                k, g = k - (1 << BITS), g.reshape(2, -1)
                tree[k:k + _TREE_BLOCK] += np.clip(rate * g[0] / (g[1] + shrink / 4), -2, 2).astype(np.float32)
        np.clip(weights, -8, 8, out=weights)
        np.clip(tree, -8, 8, out=tree)
    return model


def lm_scores(docs: DataFrame, steps: int = STEPS, shrink: float = SHRINK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10 probabilities).

    ``base_score`` is the add-one unigram score of the tokens.  A null text is empty: its only token is its end.  A null id is
    learned from.  Without training documents every word is unseen.  Rows of equal ids each have a score and each count;
    other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_type = dict(docs.dtypes)[id_col]
    chunks = encode_chunks(docs, id_col, text_col)
    words = count_words(chunks)
    classes = make_classes(words)
    counted = with_counts(chunks, words)
    shared = spark.sparkContext.broadcast(train(counted, classes, steps, shrink=shrink))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = model.classes
        size = known.tokens + known.types + 1
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.column("vocabulary")[i].as_py(), batch.column("tokens")[i].as_py(), known)
                n, t = len(chunk.sizes), chunk.tokens
                doc = np.repeat(np.arange(n), chunk.sizes)
                starts = starts_of(chunk.sizes)[doc]
                score = chunk.in_leaf[t]
                for at in range(0, len(t), 16_384):
                    s = np.arange(at, min(at + 16_384, len(t)))
                    f, label = chunk.features(s, starts[s]), chunk.label[t[s]]
                    p = class_probabilities(model.weights, model.bias, f)
                    score[s] += np.log10(np.maximum(p[np.arange(len(s)), label], 1e-30)) + log_leaf(model, f, label, chunk.leaf[t[s]])
                base = np.log10((chunk.count + 1) / size)[t]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1).flatten(), pa.array(chunk.held_out), pa.array(chunk.sizes.astype(np.int64)),
                     pa.array(np.bincount(doc, chunk.count[t] > 0, n).astype(np.int64)), pa.array(np.full(n, known.tokens, np.int64)),
                     pa.array(np.bincount(doc, base, n)), pa.array(np.bincount(doc, score, n))],
                    names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return in_arrow(counted.select("ids", "vocabulary", "tokens"), run,
                    f"`{id_col}` {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
