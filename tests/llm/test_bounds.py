"""Bounds of caches and of what comes to the driver."""

import gc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flighttables.llm import quality_rules
from flighttables.llm._common import KEPT_WORD, WordCodes, WordHashes
from flighttables.llm.features import TextFeatures
from flighttables.llm.token_files import END_ID, Encoder


def long_words(n, start=0):
    return [(b"%d" % i).rjust(500, b"w") for i in range(start, start + n)]


def test_caches_of_words_are_bounded_in_bytes():
    hashes, codes, features = WordHashes(), WordCodes(most=1_000_000), TextFeatures(12)
    for at in range(0, 100_000, 1_000):
        some = long_words(1_000, at)
        assert len(set(hashes.encode(some + some[:3]).tolist())) == 1_000
        got = codes.encode(some + some[:3])
        assert got[-3:].tolist() == got[:3].tolist() and len(set(got.tolist())) == 1_000
        assert sum(map(len, codes.ids)) <= 1_500_000
        if not at % 20_000:
            features(b" ".join(some).decode())
    assert not hashes.cache and not features.cache and KEPT_WORD < 500
    assert hashes.encode([b"a", b"b" * 70, b"a"]).tolist()[::2] == [hashes.fn(b"a")] * 2 and list(hashes.cache) == [b"a"]


def test_encoder_is_bounded_in_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = Encoder(path, most=200_000), Encoder(path)
    for at in range(0, 3_000, 100):
        text = b" ".join(long_words(100, at)).decode()
        ids, lengths = encoder.encode([text, None])
        assert encoder.held <= 400_000 and lengths.tolist() == [len(ids) - 1, 1] and ids[-1] == END_ID
        if not at % 1_000:
            assert (ids == plain.encode([text, None])[0]).all()


def test_encoder_forgets_rare_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = Encoder(path, limit=60), Encoder(path)
    rng = np.random.default_rng(3)
    common = [f"word{i}" for i in range(20)]
    for k in range(60):
        texts = [" ".join([*rng.choice(common, 30), *(f"rare{k}x{i}" for i in range(int(rng.integers(0, 25))))]) + "." for _ in range(3)]
        got, want = encoder.encode(texts), plain.encode(texts)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and len(encoder.place) <= 60 + 80
    assert {w.encode() for w in common} <= set(encoder.place) and list(encoder.place.values()) == list(range(len(encoder.place)))


def test_the_sample_of_rule_costs_stays_in_the_tasks(spark):
    docs = spark.range(0, 20_000, 1, 50).select(F.col("id").alias("doc_id"), F.concat(F.lit("a few words and a number "), F.col("id").cast("string"),
                                                                                     F.repeat(F.lit(" more of them"), 30)).alias("text"))
    got = quality_rules.rule_costs(docs, quality_rules.RULES, 500, "doc_id", "text")
    assert sorted(r["rule"] for r in got.collect()) == sorted(r.name for r in quality_rules.RULES)
    assert len(quality_rules.order_rules(docs, quality_rules.RULES, 500, "doc_id", "text")) == len(quality_rules.RULES)

    calls = spark.sparkContext.accumulator(0)
    rule = quality_rules.Rule("counted", lambda text, tokens: (calls.add(1), True)[1])
    row, = quality_rules.rule_costs(docs, (rule,), 500, "doc_id", "text").collect()
    assert calls.value == row["rejections"] and 350 <= calls.value <= 650
    none = docs.limit(0)
    assert [r.name for r in quality_rules.order_rules(none, quality_rules.RULES, 500, "doc_id", "text")] == [r.name for r in quality_rules.RULES]


def test_encoder_learns_words_without_keeping_the_collector_busy():
    """No list stays for each word that is learned: tens of thousands of them made the garbage collector run again and again."""
    path = public_tokenizers.path("word_bpe_49k.json")
    letters = "abcdefghijklmnopqrst"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters[:4]]
    words += [w + end for w in words[:2_000] for end in ("é", "7", "中")]
    encoder, runs = Encoder(path), []
    count = lambda phase, info: runs.append(phase)
    gc.collect()
    gc.callbacks.append(count)
    try:
        ids, lengths = encoder.encode([" ".join(words), None])
    finally:
        gc.callbacks.remove(count)
    want = encoder.tok.encode(" ".join(words), add_special_tokens=False).ids
    assert ids.tolist() == [*want, END_ID, END_ID] and lengths.tolist() == [len(want) + 1, 1]
    assert runs.count("start") <= 4
