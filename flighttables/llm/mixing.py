"""Soft-membership mixing of documents to target weights of domains.

1. A softmax classifier over hashed words and structure statistics, fitted on a bounded sample of the
   documents that the label table names, predicts each document's domain posterior ``p`` (soft membership).
2. Rates ``x_d >= 0`` minimise ``1/2 sum_k w_k (sum_d t_d p_dk x_d - T_k)^2`` with ``t_d`` the tokens (words) of a
   document and ``T_k`` the target token total of domain k, by projected gradient from ``x = 1``.  The step
   of a document is scaled by ``1 / t_d``, so ``x_d <- max(0, x_d - p_d . g)`` with one vector ``g`` of
   domains per iteration, the gap to the targets by the curvature of the rates that can move: an iteration is one small
   aggregate, and the rates follow from the list of past ``g`` alone.  A gap counts by its share of the target, so a
   domain that hardly any document belongs to is not filled with documents of the others; it falls short of its target
   and the log says by how much.
3. A document is taken ``floor(rate)`` times, once more with the probability of the remainder (by a hash of its
   id and text); only rounding noise (``snap``) is taken for a whole number, so copies realise the rates.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, carried, in_arrow, staged
from flighttables.llm.features import N_STATS, TextFeatures, csr
from flighttables.llm.quality_classifier import training_rows

log = logging.getLogger(__name__)

#: Domain of a labelled document, as SQL over the label table, and the weight each domain shall have.
DOMAIN = "case when toxic = 1 then 'toxic' when toxic = 0 then 'clean' end"
TARGETS = {"clean": 0.995, "toxic": 0.005}
ANCHOR = "clean"
#: The same for the corpus (``op2_mixing`` and the pipeline): documents of poor quality are a domain of their own.
CORPUS_DOMAIN = "case when toxic = 1 then 'toxic' when quality = 0 then 'poor' when quality = 1 then 'clean' end"
CORPUS_TARGETS = {"clean": 0.985, "poor": 0.01, "toxic": 0.005}
#: Bound of the rates in :func:`fit_rates` if none is given; :func:`mixing_rates` sets none.
MOST = 2.0
#: Least damping of a step, as a share of the targets.
RIDGE = 1e-2


def fit_softmax(rows, n_classes: int, size: int, epochs: int = 15, batch: int = 64, rate: float = 0.15, seed: int = 11):
    """Weights (size x classes) and biases by Adagrad; without rows every class is as likely."""
    w, b = np.zeros((size, n_classes), np.float32), np.zeros(n_classes)
    if not rows:
        return w, b
    rng = np.random.default_rng(seed)
    y = np.array([r[2] for r in rows])
    b += np.log((np.bincount(y, minlength=n_classes) + 0.5) / len(y))
    gw = np.full((size, n_classes), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at:at + batch]
            starts, index, value = csr([(rows[i][0], rows[i][1]) for i in some])
            err = posteriors(w, b, starts, index, value)
            err[np.arange(len(some)), y[some]] -= 1
            err /= len(some)
            owner = np.repeat(np.arange(len(some)), np.diff(np.append(starts, len(index))))
            used, place = np.unique(index, return_inverse=True)
            g = np.stack([np.bincount(place, err[owner, k] * value, len(used)) for k in range(n_classes)], axis=1) + 1e-6 * w[used]
            gw[used] += g ** 2
            w[used] -= (rate * g / np.sqrt(gw[used])).astype(np.float32)
    return w, b


def posteriors(w, b, starts, index, value) -> np.ndarray:
    z = np.add.reduceat(w[index] * value[:, None], starts, axis=0) + b
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def with_posteriors(docs: DataFrame, labels: DataFrame, domains: list[str], domain: str, max_train: int, bits: int,
                    id_col: str, text_col: str, keep: bool) -> DataFrame:
    """``docs`` (all columns as ``_c0``..., or the id alone) with ``_t`` words, ``_u`` in [0, 1) and ``_p`` posterior."""
    number = "case " + " ".join(f"when d = '{k}' then {i}" for i, k in enumerate(domains)) + " end"
    labels = labels.select(labels[id_col], F.expr(domain).alias("d"))
    w, b = fit_softmax(training_rows(docs, labels, number, max_train, bits, id_col, text_col, None), len(domains), N_STATS + (1 << bits))
    shared = docs.sparkSession.sparkContext.broadcast((w, b))  # domains * 2^bits floats
    given = docs.columns if keep else [id_col]
    n_chars = docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    columns, text = carried(docs, given, text_col)
    rows = docs.select(*columns, n_chars.alias("_n"), F.pmod(F.xxhash64(docs[id_col], docs[text_col], F.lit("mix")), F.lit(1 << 30)).alias("_h"))
    types = [f.dataType.simpleString() for f in rows.schema.fields[:len(given)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, (w, b) = TextFeatures(bits), shared.value
        for batch in blocks(batches, text):
            got = [features(t, n) for t, n in zip(batch.column(text).to_pylist(), batch.column("_n").to_pylist())]
            p = posteriors(w, b, *csr([g[:2] for g in got]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(types)], pa.array([g[2] for g in got], pa.int64()),
                 pa.array(np.array(batch.column("_h").to_pylist(), np.float64) / (1 << 30)),
                 pa.array(p.astype(np.float64).tolist(), pa.list_(pa.float64()))],
                names=[*batch.schema.names[:len(types)], "_t", "_u", "_p"])

    return in_arrow(rows, run, ", ".join([*(f"_c{i} {t}" for i, t in enumerate(types)), "_t long", "_u double", "_p array<double>"]))


def _rate(history: list[list[float]], most: float | None) -> F.Column:
    """The rate of a document after the steps in ``history`` (each already scaled by the step)."""
    if not history:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(g)) for g in step]) for step in history])
    bound = (lambda x: F.least(F.lit(float(most)), x)) if most is not None else (lambda x: x)
    return F.aggregate(steps, F.lit(1.0), lambda x, g: bound(F.greatest(
        F.lit(0.0), x - F.aggregate(F.zip_with("_p", g, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))))


def fit_rates(rows: DataFrame, weights: np.ndarray, anchor: int | None, total: float | None, tolerance: float, iterations: int,
              most: float | None = MOST):
    """Steps of the projected gradient, the totals reached and the targets; ``rows`` has ``_t`` and ``_p``."""
    k = len(weights)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def measure(history):
        """Totals of the domains, and the curvature among documents whose rate can move."""
        moves = (F.col("_x") > 0) & (F.col("_x") < (np.inf if most is None else most))
        got = (rows.select("_t", "_p", _rate(history, most).alias("_x"))
               .agg(*[F.sum(F.col("_t") * F.col("_p")[i] * F.col("_x")).alias(f"a{i}") for i in range(k)],
                    *[F.sum(F.when(moves, F.col("_t") * F.col("_p")[i] * F.col("_p")[j])).alias(f"h{i}_{j}") for i, j in pairs]).first())
        h = np.zeros((k, k))
        for i, j in pairs:
            h[i, j] = h[j, i] = got[f"h{i}_{j}"] or 0.0
        return np.array([got[f"a{i}"] or 0.0 for i in range(k)]), h

    have, h = measure([])
    if not have.sum():
        return [], have, np.zeros(k)
    if total is None:  # the anchor domain keeps its total, or the whole does
        total = have[anchor] / weights[anchor] if anchor is not None and weights[anchor] else have.sum()
    target = total * weights
    share = np.maximum(target, 0.01 * total)  # a gap counts by its share of this: what a domain lacks is not bought with much of the others
    miss = lambda a: float(((a - target) ** 2 / share).sum())
    history: list[list[float]] = []
    damp = RIDGE
    for _ in range(iterations):
        gap = have - target
        if np.all(np.abs(gap) <= tolerance * share):
            break
        step = np.linalg.solve(h + damp * np.diag(share), gap).tolist()
        now, curve = measure([*history, step])
        if miss(now) > miss(have):  # too far
            damp *= 10
            continue
        history.append(step)
        done, have, h, damp = miss(now) > (1 - 1e-4) * miss(have), now, curve, max(RIDGE, damp / 10)
        if done:  # the rest is out of reach
            break
    return history, have, target


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: str = DOMAIN,
                 anchor: str | None = ANCHOR, total: float | None = None, max_train: int = 6000, bits: int = 14,
                 tolerance: float = 1e-3, iterations: int = 30, snap: float = 1e-6, most: float | None = None, id_col: str = "doc_id",
                 text_col: str = "text", keep: bool = False) -> DataFrame:
    """Rate and copies of every document so that the expected domain totals come as near to the targets as they can.

    ``targets`` are weights of the domains that the SQL expression ``domain`` gives over ``labels`` (scaled to sum
    1); the total is ``total`` words, or such that ``anchor`` keeps its expected total.  Returns id, ``n_words``,
    ``posterior`` (in the order of ``targets``), ``rate``, ``copies``; with ``keep`` all columns of ``docs``, each row
    ``copies`` times.  The rates have no upper bound
    unless ``most`` is given; a total that misses its target by over 1 % is logged.  A null text has no words; its rate
    follows from its posterior, 1 at most, and moves no total.  Without labels
    all domains are as likely.  Repeated rows count as often as they occur; an empty table gives none.
    """
    targets = targets or TARGETS
    domains = list(targets)
    weights = np.array([float(v) for v in targets.values()])
    weights = weights / weights.sum()
    given = docs.columns if keep else [id_col]
    rows = staged(with_posteriors(docs, labels, domains, domain, max_train, bits, id_col, text_col, keep), "mixing")
    history, have, target = fit_rates(rows, weights, domains.index(anchor) if anchor in domains else None, total, tolerance, iterations, most)
    for k, a, b in zip(domains, have, target):
        if abs(a - b) > 0.01 * b:
            log.warning("mixing: domain %s has %.6g words of its target %.6g", k, a, b)
    rate = _rate(history, most)
    rate = F.when(F.col("_t") == 0, F.least(F.lit(1.0), rate)).otherwise(rate)  # more of nothing moves no total
    near = F.round("_rate")
    copies = F.when(F.abs(F.col("_rate") - near) <= snap, near).otherwise(F.floor(F.col("_rate") + F.col("_u"))).cast("int")
    out = rows.withColumn("_rate", rate).withColumn("_copies", copies)
    if keep:
        return (out.where("_copies > 0").withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
                .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(given)]))
    return out.select(F.col("_c0").alias(id_col), F.col("_t").alias("n_words"), F.col("_p").alias("posterior"),
                      F.col("_rate").alias("rate"), F.col("_copies").alias("copies"))
