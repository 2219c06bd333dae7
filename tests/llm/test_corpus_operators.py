"""Every corpus operator against brute force, on rows with nulls, empty and long texts, repeats and clashing columns."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flighttables.llm import decontamination, html_text, lm_scoring, mixing, near_dedup, quality_classifier, quality_rules
from flighttables.llm import substring_dedup, token_counts, token_files
from flighttables.llm.features import N_STATS, csr

WORDS = [a + b for a in ("ba", "do", "ki", "lu", "mé", "no") for b in ("ra", "sel", "tim", "von", "x", "日本")]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, chunk long, key string, _text string, "
          "_c0 string, _t long, score double, words binary, n_words string")


def prose(rng, n, vocabulary=WORDS):
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def corpus():
    """(doc_id, text) with copies, near copies, junk, shared passages, blank and null texts, repeated rows and ids."""
    rng = random.Random(5)
    base = prose(rng, 300)
    words = base.split(" ")
    near = " ".join(w if i not in (40, 41) else "edit" for i, w in enumerate(words))
    passage = prose(rng, 60)
    texts = [base, base, near, passage + " " + prose(rng, 50), prose(rng, 30) + " " + passage, None, "", " \t\n ", "one",
             "a b c d", "a b c d", ("spam " * 40).strip(), "A B!! C!! " * 30, "x# y& " * 40, "<|endoftext|> <s> ▁   é \x00 \x1c end",
             prose(rng, 3000), "w" * 5000, "line one here\nline one here\n\nline two", passage, passage + "\n" + passage,
             " ".join(str(i) for i in range(200)), base.encode().upper().decode()]
    rows = list(enumerate(texts))
    return rows + [(0, texts[0]), (None, base), (None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, None, None if d == 3 else len(t or ""), "id", 7, "k", "other", "c", 3, 0.5, b"w", "n")
                                  for d, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, rows):
    return spark.createDataFrame([(d, int("!!" not in (t or "") and "#" not in (t or "") and "spam" not in (t or "")), 0, "x") for d, t in rows
                                  if d is not None] + [(None, 1, 0, "x"), (1, None, None, "x"), (99, 1, 1, "x")],
                                 "doc_id long, quality int, toxic int, text string")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def as_set(df):
    return collections.Counter(tuple(r) for r in df.collect())


# --- 1 token files

def test_token_files_equal_the_library(spark, docs, rows, no_docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for d, t in order:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        start += len(ids)
    for shard_tokens in (1, 700, 500_000):
        files = token_files.write_token_files(docs, path, shard_tokens=shard_tokens)
        got = token_files.read_token_files(spark, files)
        assert as_set(got) == collections.Counter(want)
    assert token_files.read_token_files(spark, token_files.write_token_files(no_docs, path)).count() == 0


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for n, top in ((1, 5), (50, 2), (4000, 6), (4000, 3000)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        cuts = np.sort(rng.integers(0, n + 1, 5))
        lengths = np.diff(np.concatenate(([0], cuts, [n])))
        rules, sizes, symbols = token_files.compress(ids, lengths, base=3000, min_count=4)
        shard = token_files.Shard(rules, sizes, symbols, 3000)
        assert (shard.ids() == ids).all()
        for _ in range(30):
            a, b = np.sort(rng.integers(0, n + 1, 2))
            assert (shard.ids(int(a), int(b)) == ids[a:b]).all()
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1][lengths > 0]
        assert set(starts) <= {0, *shard.ends.tolist()}  # a document begins with a symbol
        if n == 4000 and top == 6:
            assert len(symbols) + 2 * len(rules) < n / 1.5 and len(rules)


def test_tokenizer_without_safe_spaces_encodes_whole_texts():
    encoder = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Hello  WORLD it's", None, "", "x́ é　日本 ẞ"]
    a = encoder.encode(texts)
    encoder.apart = False
    b = encoder.encode(texts)
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_grammar_leaves_no_frequent_pair():
    rng = np.random.default_rng(6)
    passage = rng.integers(0, 5000, 400)
    docs = [np.concatenate((rng.integers(0, 5000, 30), passage, rng.integers(0, 5000, 30))) for _ in range(40)] + [np.full(999, 7), np.zeros(0, int), [3]]
    docs += [rng.integers(0, 90000, 300) for _ in range(300)]  # more symbols than 16 bits hold
    ids, lengths = np.concatenate(docs).astype(np.uint32), np.array([len(d) for d in docs])
    for n in (44, len(docs)):
        some, of = ids[:lengths[:n].sum()], lengths[:n]
        rules, sizes, symbols = token_files.compress(some, of, 90000)
        shard = token_files.Shard(rules, sizes, symbols, 90000)
        assert shard.ids().tolist() == some.tolist() and shard.ids(500, 900).tolist() == some[500:900].tolist()
        ends = set(np.cumsum(of).tolist())
        assert {0, *ends} <= {0, *shard.ends.tolist()}  # no symbol spans documents
        pairs = collections.Counter((a, b) for a, b, e in zip(symbols.tolist(), symbols[1:].tolist(), shard.ends.tolist()) if e not in ends)
        assert max(pairs.values()) < 8 and sizes.max() >= 400


# --- 2 mixing

def test_mixing_reaches_reachable_targets(spark, no_docs):
    rng = random.Random(1)
    texts = [("red " * 3 + prose(rng, 40)) if i % 3 else ("blue " * 3 + prose(rng, 60)) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, "red" if i % 3 else "blue") for i in range(0, 600, 2)], "doc_id long, colour string")
    got = mixing.mixing_rates(docs, labels, {"red": 0.5, "blue": 0.5}, domain="colour", anchor=None, total=24_000.0).collect()
    totals = [sum(r["n_words"] * r["posterior"][k] * r["rate"] for r in got) for k in range(2)]
    assert totals == pytest.approx([12000, 12000], rel=0.01)
    assert all(r["rate"] >= 0 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in got)
    held_out = [(r["posterior"][0] > 0.5) == bool(r["doc_id"] % 3) for r in got if r["doc_id"] % 2]
    assert sum(held_out) / len(held_out) > 0.9
    none = mixing.mixing_rates(no_docs, labels, {"red": 0.5, "blue": 0.5}, domain="colour")
    assert none.count() == 0


def test_projected_gradient_equals_a_plain_one(spark):
    rng = np.random.default_rng(0)
    t, p = rng.integers(1, 50, 40), rng.dirichlet([0.3, 0.3, 0.3], 40)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "_t long, _p array<double>")
    weights = np.array([0.45, 0.3, 0.25])
    history, have, target = mixing.fit_rates(rows, weights, None, None, 1e-6, 25)
    x = np.ones(40)
    for step in history:
        x = np.clip(x - p @ np.array(step), 0, mixing.MOST)
    assert have == pytest.approx((t * x) @ p, rel=1e-9)
    before, after = (t @ p - target), (t * x) @ p - target
    assert (after ** 2).sum() < 0.01 * (before ** 2).sum()
    lopsided, have, target = mixing.fit_rates(rows, np.array([0.98, 0.02, 0.0]), None, None, 1e-6, 8)  # out of reach
    x = np.ones(40)
    for step in lopsided:
        x = np.clip(x - p @ np.array(step), 0, mixing.MOST)
    assert x.max() == mixing.MOST and x.min() == 0 and have == pytest.approx((t * x) @ p, rel=1e-9)


def test_mixing_edge_rows(spark, docs, rows):
    labels = labels_of(spark, rows)
    got = mixing.mixing_rates(docs, labels)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"]) for r in got.collect()) == \
        sorted((d is not None, d or 0, len(split(t))) for d, t in rows)
    kept = mixing.mixing_rates(docs, labels, keep=True)
    assert kept.columns == docs.columns
    copies = {(r["doc_id"], r["n_words"]): r["copies"] for r in got.collect()}
    assert kept.count() == sum(copies[(d, len(split(t)))] for d, t in rows)
    nothing = mixing.mixing_rates(docs, labels.limit(0)).collect()
    assert all(r["posterior"] == pytest.approx([1 / 2] * 2) for r in nothing)


def test_rates_reach_targets_of_rare_domains_without_a_bound(spark):
    rng = np.random.default_rng(3)
    n = 4000
    t, kind = rng.integers(20, 80, n), np.where(np.arange(n) % 1000 == 0, 2, np.where(np.arange(n) % 7 == 0, 1, 0))  # 0.1 % of the third
    p = np.full((n, 3), 1e-3)
    p[np.arange(n), kind] = 1 - 2e-3
    weights = np.array([0.985, 0.01, 0.005])

    def fitted(p):
        rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "_t long, _p array<double>")
        history, have, target = mixing.fit_rates(rows, weights, 0, None, 1e-3, 30, None)
        x = np.ones(n)
        for step in history:
            x = np.maximum(x - p @ np.array(step), 0)
        assert have == pytest.approx((t * x) @ p, rel=1e-9)
        return have / target, x

    reached, x = fitted(p)
    assert reached == pytest.approx([1, 1, 1], abs=5e-3) and x.max() > mixing.MOST
    p[kind == 1] = [1 - 1e-3 - 1e-6, 1e-6, 1e-3]  # nobody is of the second: it falls short, and the others do not pay for it
    p[kind == 0] = [1 - 1e-3 - 1e-6, 1e-6, 1e-3]
    p[kind == 2, 1] = 1e-6
    reached, x = fitted(p / p.sum(axis=1, keepdims=True))
    assert reached[1] < 1e-3 and reached[[0, 2]] == pytest.approx([1, 1], abs=0.02) and x.sum() < 1.2 * n


def test_copies_realise_the_targets(spark):
    rng = random.Random(4)
    texts = [("red " * 8 + prose(rng, 30)) if i % 2 else ("blue " * 8 + prose(rng, 30)) for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, "red" if i % 2 else "blue") for i in range(0, 1200)], "doc_id long, colour string")
    have = sum(len(t.split()) for t in texts)
    got = mixing.mixing_rates(docs, labels, {"red": 0.95, "blue": 0.05}, domain="colour", total=0.55 * have).collect()  # rates near 1.05 and 0.05
    taken = np.array([sum(r["n_words"] * r["posterior"][k] * r["copies"] for r in got) for k in range(2)])
    assert taken == pytest.approx(0.55 * have * np.array([0.95, 0.05]), rel=0.25)
    assert taken[0] == pytest.approx(0.55 * have * 0.95, rel=0.02)


def test_poor_is_a_domain_of_the_corpus(spark, tmp_path):
    from flighttables.llm.queries import op2_mixing
    import corpus_pipeline
    rng = random.Random(8)
    texts = [prose(rng, 60) for _ in range(600)]
    poor, bad = [i % 5 == 1 for i in range(600)], [i % 12 == 2 for i in range(600)]
    texts = [" ".join(w + "##" for w in t.split()) if j else t.replace(" ", " idiot ") if b else t for t, j, b in zip(texts, poor, bad)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(not poor[i]), int(bad[i])) for i in range(600)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op2_mixing(spark, str(tmp_path)).collect()
    totals = np.array([sum(r["n_words"] * r[f"p_{k}"] * r["rate"] for r in got) for k in ("clean", "poor", "toxic")])
    assert totals / totals.sum() == pytest.approx([0.985, 0.01, 0.005], abs=1e-3)
    mixed = collections.Counter(r["doc_id"] for r in corpus_pipeline.mixing(spark, docs, str(tmp_path)).collect())
    only_poor = [i for i in range(600) if poor[i] and not bad[i]]
    assert sum(mixed[i] for i in only_poor) < 0.2 * len(only_poor)


# --- 3 pages

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a < b) "</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News &amp; co</a></ul></nav>
<div class="cookie-notice">We use cookies</div><%s><h1>Title &amp; more</h1><p>First <b>para with <a href="q>r">a link</a> in it,
enough   words here to count<!-- gone --> well.<p>Second 1 < 2 &eacute;t&eacute; &#x4e2d; x</p><div class="ad">Buy now</div>
<p>Third paragraph has some more of the words.</p><form><label>Mail</label><input></form>
<section id="comments"><p>I am a reader with a comment</p></section></%s><aside><p>Related things here</p></aside>
<footer>&copy; me</footer>"""


def test_html_regions(spark):
    pages = [(i, f"u{i}", PAGE % ("article", "article")) for i in range(5)] + [(5, None, PAGE % ("div", "div")), (6, "n", None), (7, "e", ""),
             (8, "t", "just <b>text</b> without any frame around it"), (8, "t", "just <b>text</b> without any frame around it"),
             (9, "c", "<article><p>never closed <!-- and gone"), (None, "x", "<nav><a>only</a><a>links</a></nav>"),
             (10, "q", "<article>" + '<p title="' + "x" * 20_000 + " <b>bad quote <p>words after it")]
    df = spark.createDataFrame([(*p, "clash", 3) for p in pages], "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract_text(df)
    text = "Title & more\nFirst para with a link in it, enough words here to count well.\nSecond 1 < 2 été 中 x\n" \
           "Third paragraph has some more of the words."
    by = {r["page_id"]: (r["url"], r["text"]) for r in got.collect()}
    assert by[0] == ("u0", text) and by[5] == (None, text)
    assert by[6][1] == by[7][1] == by[None][1] == ""
    assert by[8][1] == "just text without any frame around it" and by[9][1] == "never closed"
    assert got.count() == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got.collect())
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_best_region_is_the_greatest_sum():
    rng = random.Random(2)
    for _ in range(200):
        x = [rng.choice([-2.0, -1.0, 0.0, 1.0, 3.0]) for _ in range(rng.randint(0, 12))]
        a, b = html_text.best_region(x)
        assert sum(x[a:b]) == max([0.0] + [sum(x[i:j]) for i in range(len(x)) for j in range(i, len(x) + 1)])


def test_html_markup_that_is_none():
    for page in ("a < b <3 <> </ > c", "<p>x<script>never ends", "<!-", "<", "&amp &nope; &#0;", "<a", "<p" + " a" * 5000):
        html_text.main_text(page, {})
    assert html_text.main_text("<p>a b c &lt;tag&gt; 1<2", {}) == "a b c <tag> 1<2"
    assert html.unescape("&lt;") == "<"


# --- 4 decontamination

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(rows, items, window=10):
    found = collections.defaultdict(set)
    for k, t in items:
        w = item_words(t)
        if k is not None and w:
            m = min(window, len(w))
            for i in range(len(w) - m + 1):
                found[tuple(w[i:i + m])].add(str(k))
    out = []
    for d, t in rows:
        w, hit, names = item_words(t), set(), set()
        for m in {len(k) for k in found}:
            for i in range(len(w) - m + 1):
                if names_of := found.get(tuple(w[i:i + m])):
                    names |= names_of
                    hit.update(range(i, i + m))
        out.append((d, len(w), len(hit), tuple(sorted(names))))
    return collections.Counter(out)


def test_decontamination_equals_brute_force(spark, docs, rows, no_docs):
    text = dict((d, t) for d, t in rows if d is not None)
    w = item_words(text[0])
    items = [(1, " ".join(w[20:45])), (2, " ".join(w[100:110]).upper()), (3, "b, c"), (4, "spam spam"), (5, None), (6, "-"), (None, text[3]),
             (7, " ".join(w[30:60])), (8, " ".join(w[30:60])), (10, text[19]), (9, "absent word"), (11, " ".join(str(i) for i in range(190, 210)))]
    benchmark = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id int, text string, doc_id int")
    want = contamination(rows, items)
    for block_bytes in (8 << 20, 60):  # one block of items, and many
        got = decontamination.find_contamination(docs, benchmark, block_bytes=block_bytes)
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()) == want
        for r in got.collect():
            assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
    clean = decontamination.find_contamination(docs, benchmark, keep=True)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for (_, _, hit, _), n in want.items() if not hit)
    nothing = decontamination.find_contamination(docs, benchmark.limit(0))
    assert all(r["n_hit"] == 0 and not r["items"] for r in nothing.collect()) and nothing.count() == len(rows)
    assert decontamination.find_contamination(no_docs, benchmark).count() == 0


def test_longest_matches_equal_naive_search():
    rng = np.random.default_rng(4)
    for _ in range(30):
        ids, query = rng.integers(0, 4, 60), rng.integers(1, 5, 12)
        ends = np.full(12, 12)
        order = decontamination.suffix_array(ids, 12)
        length, lo, hi, _, _ = decontamination.longest_matches(ids, order, query, ends, np.full(12, 3))
        for q in range(12):
            best, at = 0, set()
            for i in range(60):
                k = 0
                while q + k < 12 and i + k < 60 and ids[i + k] == query[q + k]:
                    k += 1
                if k > best:
                    best, at = k, set()
                if k == best and k:
                    at.add(i)
            assert length[q] == best and set(order[lo[q]:hi[q]].tolist()) == at


# --- 5 repeated passages

def removed(rows, window):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), []
    for d, t in order:
        w, gone = split(t), set()
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if k in seen:
                gone.update(range(i, i + window))
            seen.add(k)
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return collections.Counter(out)


def test_substring_dedup_equals_brute_force(docs, rows, no_docs):
    once = [(d, t) for d, t in rows if d is not None][:-1]
    for hot in (20_000, 2):  # anchors split by window
        got = substring_dedup.drop_repeats(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), hot=hot)
        assert as_set(got) == removed(once, 20)
    everything = substring_dedup.drop_repeats(docs, window=12, gram=5).select("doc_id", "n_words", "n_removed").collect()
    want = removed(rows, 12)
    assert collections.Counter(tuple(r) for r in everything) == collections.Counter(k[:3] for k in want.elements())
    assert substring_dedup.drop_repeats(no_docs).count() == 0


def test_word_hashes_go_by_the_word(monkeypatch):
    texts = [b"", b" a bb  a\n", b"\x0b", b"ccc bb " * 50, "é日本 \u00a0x".encode(), b"w" * 300 + b" a"]
    whole = substring_dedup.hash_words(texts)
    words = [w for t in texts for w in t.split()]
    assert [whole[0][s:e] for s, e in zip(whole[1], whole[2])] == words and whole[4].tolist() == [len(t.split()) for t in texts]
    assert len({(w, h) for w, h in zip(words, whole[3].tolist())}) == len(set(words)) == len(set(whole[3].tolist()))
    monkeypatch.setattr(substring_dedup, "_BLOCK", 64)
    assert [h for w, h in zip(words, substring_dedup.hash_words(texts)[3].tolist()) if len(w) < 64] == \
        [h for w, h in zip(words, whole[3].tolist()) if len(w) < 64]


def test_matching_statistics_equal_naive_search():
    from flighttables.llm.fm_index import FMIndex
    rng = np.random.default_rng(9)
    for _ in range(20):
        text = rng.integers(0, 5, 70)
        text[-1] = 0
        index = FMIndex(text, 6)
        query = rng.integers(0, 6, 25)
        query[query == 5] = 1
        length, lo, hi = index.statistics(query, np.arange(1, 26), 6)
        for e in range(1, 26):
            best = 0
            for k in range(1, 7):
                pattern = query[e - k:e] if e - k >= 0 else query[:0]
                if len(pattern) == k and (pattern > 0).all() and any((text[i:i + k] == pattern).all() for i in range(70 - k + 1)):
                    best = k
            assert length[e - 1] == best
            if best:
                at = {i for i in range(70 - best + 1) if (text[i:i + best] == query[e - best:e]).all()}
                assert set(index.order[lo[e - 1]:hi[e - 1]].tolist()) == at


# --- 6 rules

def test_quality_rules_equal_brute_force(docs, rows, no_docs):
    want = []
    for d, t in rows:
        w, places = split(t), collections.defaultdict(list)
        for i in range(len(w) - 7):
            places[tuple(w[i:i + 8])].append(i)
        covered = {i + j for v in places.values() if len(v) > 1 for i in v for j in range(8)}
        lines = [x for x in (t or "").split("\n") if split(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        kept = not failed and not any(r.rejects(t, [x.encode() for x in w]) for r in quality_rules.RULES)
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), failed, kept))
    got = quality_rules.quality_rules(docs)
    assert as_set(got) == collections.Counter(want)
    assert as_set(quality_rules.quality_rules(docs, rules=quality_rules.RULES[::-1], sample_rows=0)) == collections.Counter(want)
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_rules_are_ordered_by_rejections_per_second(docs):
    import time
    slow = quality_rules.Rule("slow", lambda t, w: time.sleep(0.002) or True)
    fast = quality_rules.Rule("fast", lambda t, w: True)
    never = quality_rules.Rule("never", lambda t, w: time.sleep(0.002) or False)
    assert [r.name for r in quality_rules.order_rules(docs, (never, slow, fast), 10, "doc_id", "text")] == ["fast", "slow", "never"]


# --- 7 language model

def test_lm_scores(docs, rows, no_docs):
    tokens = [(d, (t or "").encode().lower().split() + [b"\n"]) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    count = collections.Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    want = collections.Counter((d, h, len(ws), sum(w in count for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6))
                               for (d, ws), h in zip(tokens, held))
    got = lm_scoring.lm_scores(docs).collect()
    assert collections.Counter((r[0], r[1], r[2], r[3], r[4], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert lm_scoring.lm_scores(no_docs).count() == 0
    alone = lm_scoring.lm_scores(docs.where("doc_id = 2")).collect()
    assert held[2] == alone[0]["held_out"] and alone[0]["train_tokens"] == (0 if held[2] else len(tokens[2][1]))


def test_lm_probabilities_sum_to_one_and_learn(spark):
    rng = random.Random(8)
    texts = []
    for i in range(300):  # words of two tongues that never mix
        texts.append(" ".join(rng.choice(WORDS[:18] if i % 2 else WORDS[18:]) for _ in range(60)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chunks = lm_scoring.encode_chunks(docs, "doc_id", "text")
    words = lm_scoring.count_words(chunks)
    classes = lm_scoring.make_classes(words)
    counted = lm_scoring.with_counts(chunks, words)
    model = lm_scoring.train(counted, classes, shrink=20)
    vocabulary = words.where("first").collect()
    size = np.array([r["total"] for r in vocabulary])
    label = classes.of(size, np.array([r["shape"] for r in vocabulary]))
    within = np.bincount(label[size > 0], (size[size > 0] + 1.0), lm_scoring.CLASSES)
    within[lm_scoring.FREQUENT:] += 1
    assert within == pytest.approx(classes.mass)
    row = counted.first()
    chunk = lm_scoring.Chunk(row["vocabulary"], row["tokens"], classes)
    at = np.arange(5)
    f = chunk.features(at, np.zeros(5, np.int64))
    by_class = lm_scoring.class_probabilities(model.weights, model.bias, f)
    assert by_class.sum(axis=1) == pytest.approx(np.ones(5))
    assert classes.leaves.sum(axis=1) == pytest.approx(classes.mass) and np.abs(model.tree).max() > 0
    # all words, and an unseen one of each class of rare words, in each of the five contexts
    top = np.array([r["hash"] for r in vocabulary]).view(np.uint64) >> np.uint64(64 - classes.depth)
    label, leaf = label[size > 0], top.astype(np.int64)[size > 0]
    weight = (size[size > 0] + 1.0) / classes.leaves[label, leaf]
    unseen = np.arange(lm_scoring.FREQUENT, lm_scoring.CLASSES)
    label, leaf = np.append(label, unseen), np.append(leaf, np.zeros_like(unseen))
    weight = np.append(weight, 1 / classes.leaves[unseen, 0])
    for k in range(5):
        here = np.repeat(f[:, k:k + 1], len(label), axis=1)
        p = by_class[k, label] * 10 ** lm_scoring.log_leaf(model, here, label, leaf) * weight
        assert p.sum() == pytest.approx(1, abs=1e-5)
    scored = lm_scoring.lm_scores(docs, shrink=20).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > 0.98 * scored[1]  # log probabilities: the model is better on held-out documents


def test_lm_raises_a_word_over_others_of_its_class(spark):
    rng = random.Random(9)
    pairs = [(f"a{i}x", f"b{i}x") for i in range(40)]  # each first word has its own second one, all are about as frequent
    docs = spark.createDataFrame([(i, " ".join(w for _ in range(40) for w in rng.choice(pairs))) for i in range(400)], "doc_id long, text string").coalesce(1)
    chunks = lm_scoring.encode_chunks(docs, "doc_id", "text")
    words = lm_scoring.count_words(chunks)
    classes = lm_scoring.make_classes(words)
    counted = lm_scoring.with_counts(chunks, words)
    model = lm_scoring.train(counted, classes, shrink=20)
    row = counted.first()
    chunk = lm_scoring.Chunk(row["vocabulary"], row["tokens"], classes)
    begin = np.repeat(np.cumsum(chunk.sizes) - chunk.sizes, chunk.sizes)
    want = []
    for doc, held in enumerate(chunk.held_out):  # the score by its definition, decision by decision
        total = 0.0
        for t in range(begin[chunk.sizes[:doc].sum()], chunk.sizes[:doc + 1].sum()) if held else ():
            f, w = chunk.features(np.array([t]), begin[t:t + 1])[:, 0], chunk.tokens[t]
            z = model.bias.astype(float) + sum(model.weights[int(x) >> (64 - lm_scoring.BITS)].astype(float) for x in f)
            total += z[chunk.label[w]] - math.log(sum(map(math.exp, z)))
            below, lo, hi = classes.leaves[chunk.label[w]], 0, 1 << classes.depth
            for d in range(classes.depth):
                mid = (lo + hi) // 2
                node = lm_scoring.CLASSES * ((1 << d) - 1) + (int(chunk.label[w]) << d) + (lo * (1 << d) >> classes.depth)
                left, right = below[lo:mid].sum(), below[mid:hi].sum()
                go = chunk.leaf[w] >= mid
                if left and right:
                    places = [((int(x) >> 32 ^ node * int(lm_scoring._NODE) % 2 ** 32) * int(lm_scoring._PLACE)) % 2 ** 32 * len(model.tree) >> 32 for x in f]
                    z = math.log(right / left) + sum(float(model.tree[p]) for p in places)
                    total -= math.log1p(math.exp(-z if go else z))
                lo, hi = (mid, hi) if go else (lo, mid)
            total += math.log((chunk.count[w] + 1) / below[lo:hi].sum())
        if held:
            want.append(total / math.log(10))
    got = lm_scoring.lm_scores(docs, shrink=20).where("held_out").collect()
    assert sorted(r["score"] for r in got) == pytest.approx(sorted(want), rel=1e-3)
    assert sum(r["score"] for r in got) > 0.8 * sum(r["base_score"] for r in got)
    flat = lm_scoring.Model(classes, model.weights, model.bias, np.zeros_like(model.tree))  # the same without the second factor's features
    at = np.flatnonzero(np.repeat(chunk.held_out, chunk.sizes))
    f, w = chunk.features(at, begin[at]), chunk.tokens[at]
    assert lm_scoring.log_leaf(model, f, chunk.label[w], chunk.leaf[w]).sum() > 0.9 * lm_scoring.log_leaf(flat, f, chunk.label[w], chunk.leaf[w]).sum()


# --- 8 token counts

def test_token_counts_equal_the_library(docs, rows, no_docs):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = collections.Counter((d, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 100) for d, t in rows)
    for chunk, overlap in ((32_768, 512), (200, 8), (64, 2)):
        assert as_set(token_counts.token_counts(docs, path, limit=100, chunk_bytes=chunk, overlap_bytes=overlap)) == want
    assert token_counts.token_counts(no_docs, path).count() == 0


def test_splicing_texts_without_stable_places():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    for text in ("日本" * 300, " " * 500, "a" * 700, "▁ ▁x " * 100, "é" * 99 + " " + "z" * 300, "".join(rng.choice("ab ▁é\n日") for _ in range(900))):
        for chunk, overlap in ((50, 1), (50, 40), (128, 16)):
            assert token_counts.count_one(sp, text.encode(), chunk, overlap) == len(sp.encode(text))


# --- 9 quality classifier

def test_factorisation_machine_identity():
    rng = np.random.default_rng(1)
    m = quality_classifier.FactorisationMachine(0.3, rng.normal(size=12), rng.normal(size=(12, 3)))
    rows = [(np.array([0, 2, 5]), np.array([1.0, -2.0, 0.5])), (np.array([1]), np.array([2.0]))]
    want = [0.3 + sum(m.w[i] * x for i, x in zip(*r)) + sum(m.v[r[0][a]] @ m.v[r[0][b]] * r[1][a] * r[1][b]
            for a in range(len(r[0])) for b in range(a)) for r in rows]
    assert m.logits(*csr(rows)) == pytest.approx(want)


def test_quality_classifier(spark, docs, rows, no_docs):
    rng = random.Random(3)
    many = [(i, prose(rng, 40) if i % 3 else " ".join(w + "##" for w in prose(rng, 40).split())) for i in range(400)]
    df = spark.createDataFrame(many, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "l") for i in range(400)], "doc_id long, quality int, lang string")
    got = quality_classifier.quality_scores(df, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held) / len(held) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    assert {r["doc_id"]: r["score"] for r in quality_classifier.quality_scores(df, flipped).collect()} == {r["doc_id"]: r["score"] for r in got}
    edge = quality_classifier.quality_scores(docs, labels_of(spark, rows))
    assert edge.count() == len(rows) and all(0 <= r["score"] <= 1 and not (r["doc_id"] is None and r["held_out"]) for r in edge.collect())
    kept = quality_classifier.quality_scores(docs, labels_of(spark, rows), keep=True)
    assert kept.columns == docs.columns and kept.count() == edge.where("predicted = 1").count()
    assert {r["score"] for r in quality_classifier.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.quality_scores(no_docs, labels).count() == 0


def test_features_do_not_know_the_label_columns():
    from flighttables.llm.features import TextFeatures
    index, value, n = TextFeatures(8)(None)
    assert n == 0 and len(index) == len(value) == N_STATS


# --- 10 near duplicates

def jaccard(a, b):
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 0.0


def bags(rows):
    out = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        out[d] = collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()
    return out


def test_near_classes(docs, rows, no_docs):
    got = near_dedup.near_classes(docs).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r["class_id"] for r in got}
    sets = bags(rows)
    for a in of:
        for b in of:
            if a is not None and b is not None:
                similar = jaccard(sets[a], sets[b])
                assert not (similar > 0.9 and of[a] != of[b]) and not (similar < 0.5 and a != b and of[a] == of[b])
    assert of[1] == of[2] == of[21] == of[0] == 0 and of[10] == 9
    assert of[None] is None and [of[i] for i in (5, 6, 7)] == [5, 6, 7]
    assert near_dedup.near_classes(no_docs).count() == 0


@pytest.mark.parametrize("rare", [1 << 20, 60])
def test_document_frequencies_are_exact(spark, docs, rows, rare):
    texts = [(t,) for _, t in rows] + [("every row has these words",)] * 300
    df = spark.createDataFrame(texts, "text string").repartition(5)
    hashes = near_dedup.WordHashes()
    count = collections.Counter(h for (t,) in texts for h in near_dedup.shingles([t], hashes)[1].tolist())
    characters = sum(len(t) + 1 for (t,) in texts if t is not None)
    want = {h: 1 + math.log1p(min(characters / n, rare)) / math.log1p(rare) for h, n in count.items() if n >= characters / rare}
    got = near_dedup.shingle_weights(df, "text", rare)
    assert got.hashes.tolist() == sorted(want) and len(want) <= rare and (rare > 60) == (len(want) == len(count))
    every = np.array([*count, 5, 2 ** 64 - 1], np.uint64)
    assert np.allclose(got.of(every), [want.get(h, 2.0) for h in every.tolist()])
    none = near_dedup.shingle_weights(df.limit(0), "text")
    assert none.of(every).tolist() == [2.0] * len(every)


def test_recall_at_the_threshold(spark):
    rng = random.Random(77)
    rows = []
    for i in range(0, 900, 3):  # each with a copy of 0.8 to 0.9 or so, and one that is less alike
        words = prose(rng, 260).split()
        for k, edits in enumerate((0, rng.randrange(3, 7), rng.randrange(9, 15))):
            at = set(rng.sample(range(5, 255), edits))
            rows.append((i + k, " ".join(f"e{i}x{k}" if j in at else w for j, w in enumerate(words))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights, hashes = near_dedup.shingle_weights(df, "text"), near_dedup.WordHashes()
    side = {}
    for d, t in rows:
        _, h, n, _, _ = near_dedup.shingles([t], hashes)
        side[d] = (h, n * weights.of(h))
    similar = {(a, b): near_dedup.weighted_jaccard(side[a], side[b]) for i in range(0, 900, 3) for a, b in ((i, i + 1), (i, i + 2), (i + 1, i + 2))}
    of = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(df).collect()}
    links = [p for p, x in similar.items() if x >= near_dedup.THRESHOLD]
    edge = [p for p in links if similar[p] < 0.85]
    caught = lambda pairs: sum(of[a] == of[b] for a, b in pairs) / len(pairs)
    print(f"recall {caught(links):.4f} of {len(links)} pairs from 0.8 on, {caught(edge):.4f} of {len(edge)} from 0.8 to 0.85")
    assert len(edge) > 40 and caught(links) >= 0.99 and caught(edge) >= 0.97
    joined = collections.defaultdict(set)
    for a, b in links:
        joined[a].add(b), joined[b].add(a)
    assert all(of[d] == d or d in joined for d in of)


def test_all_links_of_a_large_group(spark):
    rng = random.Random(12)
    base = prose(rng, 200).split()
    rows = []
    for i in range(120):  # two families and strangers
        words = [w + ("x" if i % 3 == 1 else "") for w in base] if i % 3 < 2 else prose(rng, 200).split()
        at = rng.randrange(190)
        rows.append((i, " ".join(words[:at] + [f"own{i}"] * 2 + words[at + 2:])))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == (i % 3 if i % 3 < 2 else i) for i in range(120))


def test_settling_a_bucket_equals_brute_force():
    rng = np.random.default_rng(3)
    idf = rng.uniform(1, 3, 400)
    found = []
    for i in range(60):
        k = np.sort(rng.choice(40, 30, replace=False) + 40 * (i % 4)) if i % 5 else np.sort(rng.choice(400, 30, replace=False))
        found.append((k.astype(np.uint64), idf[k], rng.integers(1, 3, 30)))
    open_ = np.ones(60, bool)
    for threshold in (0.5, 0.65):
        got = near_dedup.settle(found, open_, threshold)
        parent = list(range(60))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        want = list(range(60))
        for a in range(60):
            for b in range(a):
                if near_dedup.weighted_jaccard((found[a][0], found[a][1] * found[a][2]), (found[b][0], found[b][1] * found[b][2])) >= threshold:
                    want = [want[b] if x == want[a] else x for x in want]
        for a, b in got:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        assert [[root(i) == root(j) for j in range(60)] for i in range(60)] == [[want[i] == want[j] for j in range(60)] for i in range(60)]


@pytest.mark.parametrize("members", [2, 7])
def test_last_level_compares_open_members_with_all(spark, monkeypatch, members):
    rng = random.Random(31)
    base = [f"{w}{i}" for i, w in enumerate(prose(rng, 300).split())]

    def edited(words, name, at):
        return [f"{name}{k}" if k in at else w for k, w in enumerate(words)]

    rows = [(0, base)] + [(1 + i, edited(base, f"m{i}e", range(7 + i, 300, 80))) for i in range(24)]  # all like the first
    for i in range(12):  # each like one of those only
        rows.append((100 + i, edited(rows[1 + i][1], f"x{i}e", range(35 + i, 300, 60))))
    rows = [(i, " ".join(w)) for i, w in rows]
    sets = bags(rows)
    assert all(jaccard(sets[100 + i], sets[1 + i]) > 0.82 and all(jaccard(sets[100 + i], sets[j]) < 0.75 for j in sets if j not in (1 + i, 100 + i))
               for i in range(12))
    monkeypatch.setattr(near_dedup, "MEMBERS", members)
    texts = spark.createDataFrame(rows, "id long, text string")
    bucket = texts.select(F.lit(1).cast("long").alias("bucket"), "id", F.when(F.col("id") == 0, 99).otherwise(37).cast("long").alias("degree"))
    idf = spark.sparkContext.broadcast(near_dedup.Weights(np.zeros(0, np.uint64), np.zeros(0)))
    found = near_dedup.links(bucket, texts, idf, 0.8, levels=((12, 3),)).collect()
    assert {(1 + i, 100 + i) for i in range(12)} <= {tuple(r) for r in found}
    assert all(jaccard(sets[r["a"]], sets[r["b"]]) >= 0.8 for r in found)


def test_buckets_too_large_for_a_task_go_to_sharper_bands(spark, monkeypatch):
    rng = random.Random(15)
    texts, words = [], prose(rng, 150).split()
    for i in range(80):  # a chain of edits: neighbours are alike, ends are not
        words = list(words)
        words[rng.randrange(150)] = f"w{i}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    monkeypatch.setattr(near_dedup, "MEMBERS", 5)
    monkeypatch.setattr(near_dedup, "CHARACTERS", 6000)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    assert set(want.values()) == {0} and got == want


def test_icws_agrees_as_often_as_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(2)
    h = np.sort(rng.integers(0, 2 ** 63, 80).astype(np.uint64))
    wa, wb = rng.uniform(0.5, 4, 80), rng.uniform(0.5, 4, 80)
    a, b = np.arange(80) < 70, np.arange(80) >= 10
    got = near_dedup.icws(np.concatenate((h[a], h[b])), np.concatenate((wa[a], wb[b])), np.array([70, 70]), 4000)
    want = near_dedup.weighted_jaccard((h[a], wa[a]), (h[b], wb[b]))
    assert (got[0] == got[1]).mean() == pytest.approx(want, abs=0.035)


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = {tuple(sorted(rng.sample(range(120), 2))) for _ in range(70)} | {(i, i + 1) for i in range(200, 240)}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = near_dedup.components(spark.createDataFrame(sorted(edges), "a long, b long")).collect()
    assert {r["id"]: r["class_id"] for r in got} == {x: root(x) for x in parent}
