"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document is ``sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum (v_if x_i)^2])``:
the pairwise interactions of all features in time linear in their number.  It is fitted by Adagrad on a
bounded sample of labelled documents (``max_train``, those with the least id hash) whose features are
computed on the executors; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, carried, crc_remainder, in_arrow
from flighttables.llm.features import N_STATS, TextFeatures, csr

#: Labels are learned from ids whose crc32 (of the id as text) modulo FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7


@dataclass
class FactorisationMachine:
    """Weights of the features in use (``index`` sorted): ``w`` linear, ``v`` low rank, ``b`` bias."""

    b: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        linear = np.add.reduceat(self.w[index] * value, starts)
        vx = self.v[index] * value[:, None]
        inner = np.add.reduceat(vx, starts, axis=0) ** 2 - np.add.reduceat(vx * vx, starts, axis=0)
        return self.b + linear + 0.5 * inner.sum(axis=1)

    def scores(self, starts, index, value) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(starts, index, value), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, rank: int = 4, epochs: int = 12, batch: int = 64,
        rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> FactorisationMachine:
    """Fit by Adagrad on ``(indexes, values, label)`` rows.

    Without rows every score is 1/2 (nothing is known); with one class the bias carries it.
    """
    rng = np.random.default_rng(seed)
    m = FactorisationMachine(0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, rank)).astype(np.float32))
    if not rows:
        m.v[:] = 0
        return m
    y = np.array([r[2] for r in rows], np.float64)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    m.b = float(np.log(share / (1 - share)))
    gw, gv, gb = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at:at + batch]
            starts, index, value = csr([(rows[i][0], rows[i][1]) for i in some])
            err = (m.scores(starts, index, value) - y[some]) / len(some)
            owner = np.repeat(np.arange(len(some)), np.diff(np.append(starts, len(index))))
            e = err[owner] * value
            vx = m.v[index] * value[:, None]
            total = np.add.reduceat(vx, starts, axis=0)[owner]
            used, place = np.unique(index, return_inverse=True)
            dw = np.bincount(place, e, len(used)) + decay * m.w[used]
            dv = np.stack([np.bincount(place, e * (total[:, f] - vx[:, f]), len(used)) for f in range(rank)], axis=1) \
                + decay * m.v[used]
            gw[used] += dw ** 2
            gv[used] += dv ** 2
            gb += err.sum() ** 2
            m.w[used] -= (rate * dw / np.sqrt(gw[used])).astype(np.float32)
            m.v[used] -= (0.3 * rate * dv / np.sqrt(gv[used])).astype(np.float32)
            m.b -= rate * err.sum() / np.sqrt(gb)
    return m


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_train: int, bits: int, id_col: str, text_col: str,
                  fold: tuple[int, int] | None) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features and labels of at most ``max_train`` labelled documents, outside the held-out fold.

    ``label`` is an SQL expression over ``labels``; its nulls are no labels, and of several labels of an id the
    least counts.  Only ids and labels (``max_train`` rows) are broadcast; texts stay where they are read.
    """
    known = labels.where(labels[id_col].isNotNull())
    if fold:
        known = known.where(crc_remainder(id_col, fold[0]) != fold[1])
    known = (known.groupBy(F.col(id_col).alias("id")).agg(F.min(F.expr(label)).cast("int").alias("y"))
             .where("y is not null").orderBy(F.xxhash64("id"), "id").limit(max_train))
    known = docs.sparkSession.createDataFrame(known.collect(), known.schema)
    chosen = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), _n_chars(docs))
              .join(F.broadcast(known), "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = TextFeatures(bits)
        for b in blocks(batches, "text"):
            got = [features(t, n)[:2] for t, n in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([i.astype(np.int32).tobytes() for i, _ in got], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary()), b.column("y")],
                names=["id", "i", "v", "y"])

    found = in_arrow(chosen, run, f"id {dict(docs.dtypes)[id_col]}, i binary, v binary, y int").collect()
    return [(np.frombuffer(r["i"], np.int32).astype(np.int64), np.frombuffer(r["v"], np.float32).astype(np.float64), r["y"])
            for r in sorted(found, key=lambda r: (str(r["id"]), bytes(r["i"])))]


def _n_chars(docs: DataFrame) -> F.Column:
    return (docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")).alias("n_chars")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = 6000, bits: int = 16,
                   rank: int = 4, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                   keep: bool = False) -> DataFrame:
    """Score every document; learn only from ids outside the held-out fold.

    Returns id, ``held_out``, ``score`` (probability of label 1), ``predicted`` (1 from ``threshold`` on); with
    ``keep`` the rows of ``docs`` with ``predicted`` 1, all columns as they were.  Inputs are the text and the
    column ``n_chars`` (its length where absent or null); a null text counts as empty and gets a score too.
    A null id is not held out.  Without labels every score is 0.5.  Repeated rows get equal scores; other
    columns are not read.
    """
    model = fit(training_rows(docs, labels, label, max_train, bits, id_col, text_col, (FOLDS, HELD_OUT)),
                N_STATS + (1 << bits), rank)
    shared = docs.sparkSession.sparkContext.broadcast((model.b, model.w, model.v))  # (rank + 1) * 2^bits floats

    given = docs.columns if keep else [id_col]
    columns, text = carried(docs, given, text_col)
    rows = docs.select(*columns, _n_chars(docs).alias("_n"))
    types = [f.dataType.simpleString() for f in rows.schema.fields[:len(given)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, m = TextFeatures(bits), FactorisationMachine(*shared.value)
        for b in blocks(batches, text):
            got = [features(t, n)[:2] for t, n in zip(b.column(text).to_pylist(), b.column("_n").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(types)], pa.array(m.scores(*csr(got)).astype(np.float64))],
                                             names=[*b.schema.names[:len(types)], "_score"])

    out = in_arrow(rows, run, ", ".join([*(f"_c{i} {t}" for i, t in enumerate(types)), "_score double"]))
    if keep:
        return out.where(F.col("_score") >= threshold).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(given)])
    return out.select(F.col("_c0").alias(id_col), F.coalesce(crc_remainder("_c0", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
