"""The pipeline's stages against a brute-force version on a small corpus with planted cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from flighttables.llm.mixing import mixing_rates
from tests.llm.test_corpus_operators import WORDS, bags, contamination, jaccard, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(21)
    vocabulary = [a + b for a in WORDS for b in WORDS[:12]]
    texts, quality, toxic = [], [], []
    for i in range(420):
        text = prose(rng, rng.randint(40, 90), vocabulary)
        junk, bad = i % 7 == 3, i % 10 == 4
        if bad:
            text = " ".join(w if k % 8 else "idiot scum" for k, w in enumerate(text.split()))
        if junk:
            text = " ".join(w + "##" for w in text.split())
        texts.append(text)
        quality.append(int(not junk))
        toxic.append(int(bad))
    items = [(i, prose(rng, 14, vocabulary)) for i in range(5)]
    for i in (8, 100):  # benchmark passages
        texts[i] += " " + items[i % 5][1]
    for i, of in ((200, 0), (201, 0), (202, 1)):  # exact and near copies of clean documents
        texts[i], quality[i], toxic[i] = texts[of], 1, 0
    words = texts[2].split()
    words[10] = "changed"
    texts[203], quality[203], toxic[203] = " ".join(words), 1, 0
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = [(i, t, "xx", "s", len(t)) for i, t in enumerate(texts)] + [(0, texts[0], "xx", "s", len(texts[0])), (900, None, None, None, None),
                                                                        (901, "", None, None, 0)]
    spark.createDataFrame(docs, COLUMNS).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, quality[i], toxic[i]) for i in range(420)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items, quality, toxic


def test_stages(spark, sf_dir):
    path, docs, items, quality, toxic = sf_dir
    frame = lambda rows: spark.createDataFrame(rows, COLUMNS)
    start = frame(docs)

    kept = P.quality_classifier(spark, start, path)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == start.columns
    assert sum(i in ids for i in range(420) if quality[i]) >= 0.98 * sum(quality)
    assert sum(i in ids for i in range(420) if not quality[i]) <= 2

    one = P.near_dedup(spark, start, path)
    got = [r["doc_id"] for r in one.collect()]
    sets = bags([(d, t) for d, t, *_ in docs])
    want = [d for d in sets if not any(e < d and jaccard(sets[d], sets[e]) >= 0.8 for e in sets)]
    assert sorted(got) == sorted(want) and one.columns == start.columns and {200, 201, 202, 203}.isdisjoint(got)

    clean = P.decontamination(spark, start, path)
    hit = {k[0] for k in contamination([(d, t) for d, t, *_ in docs], items) if k[2]}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, *_ in docs if d not in hit) and hit >= {8, 100}

    mixed = P.mixing(spark, start, path)
    n = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert mixed.columns == start.columns
    # the words of each domain, expected by the rates and realised by the copies, against the target weights (clean keeps its total)
    rates = mixing_rates(start, P.table(spark, path, "labels"), P.CORPUS_TARGETS, P.CORPUS_DOMAIN).collect()
    expected = dict.fromkeys(P.CORPUS_TARGETS, 0.0)
    for r in rates:
        for k, p in zip(P.CORPUS_TARGETS, r["posterior"]):
            expected[k] += r["rate"] * r["n_words"] * p
    weight = {k: v / sum(P.CORPUS_TARGETS.values()) for k, v in P.CORPUS_TARGETS.items()}
    assert all(expected[k] == pytest.approx(weight[k] * sum(expected.values()), rel=0.02) for k in expected)
    domain = ["toxic" if toxic[i] else "clean" if quality[i] else "poor" for i in range(420)]
    had, got = dict.fromkeys(expected, 0), dict.fromkeys(expected, 0)
    for i in range(420):
        had[domain[i]] += len(docs[i][1].split()) * (1 + (i == 0))
        got[domain[i]] += len(docs[i][1].split()) * n.get(i, 0)
    assert got["clean"] == pytest.approx(had["clean"], rel=0.05)
    for k in ("poor", "toxic"):  # copies are whole, so a small target is met within a few documents
        assert abs(got[k] - weight[k] * sum(got.values())) <= 0.02 * sum(had.values()) and got[k] <= 0.4 * had[k]

    from tokenizers import Tokenizer
    tok, at, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for d, t, *_ in sorted(docs, key=lambda r: (r[0], r[1] or "")):
        i = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, at, len(i), zlib.crc32(i.tobytes())))
        at += len(i)
    assert sorted(map(tuple, P.token_files(spark, start, path).collect())) == sorted(want)


def test_run_chains_the_stages(spark, sf_dir):
    path, docs, _, _, _ = sf_dir
    got = [r["doc_id"] for r in P.run(spark, path).collect()]
    texts = {d: (d, t, lang, source, n) for d, t, lang, source, n in docs}
    assert set(got) <= set(texts) and {200, 201, 202, 203, 8, 100}.isdisjoint(got) and len(got) > 200
    rows = P.table(spark, path, "documents")
    for name, stage in P.STAGES:  # the same by hand, each stage on what its predecessor kept
        rows = stage(spark, rows, path)
        if name != P.STAGES[-1][0]:
            rows = spark.createDataFrame(rows.collect(), COLUMNS)
    assert sorted(r["doc_id"] for r in rows.collect()) == sorted(got)


def test_near_dedup_keeps_unlike_rows_of_an_id(spark, sf_dir):
    path = sf_dir[0]
    rng = random.Random(4)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(1, a), (1, b), (1, a), (2, a + " x"), (3, b), (3, c), (None, a), (None, a), (4, None), (4, ""), (0, c + " y")]
    docs = spark.createDataFrame([(d, t, "xx", "s", None) for d, t in rows], COLUMNS).repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in P.near_dedup(spark, docs, path).collect()), key=str)
    assert got == sorted([(1, a), (1, b), (0, c + " y"), (None, a), (None, a), (4, None), (4, "")], key=str)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", COLUMNS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = P.table(spark, str(tmp_path), "documents")
    for _, stage in P.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
