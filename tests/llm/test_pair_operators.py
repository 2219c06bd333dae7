"""Jaccard join, hard negatives and token alignment against brute force, on nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flighttables.llm import hard_negatives as H, jaccard_join as J, token_alignment as A
from tests.llm.test_corpus_operators import WORDS, corpus, frame, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ Jaccard join

def shingle_set(text):
    w = [x.lower() for x in (text or "").encode().split()]
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute_components(rows, percent=85):
    """Per row: set size and least id reachable."""
    sets = [shingle_set(t) if d is not None else set() for d, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return collections.Counter((d, len(shingle_set(t)), least.get(top(i)) if d is not None else None) for i, (d, t) in enumerate(rows))


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = "e%d" % rng.randrange(10 ** 6)
    return " ".join(out)


def chains(seed=3):
    """Groups of near copies whose similarities lie on both sides of the threshold, and unlike documents with a common passage."""
    rng = random.Random(seed)
    vocabulary = [a + b for a in WORDS for b in WORDS]
    rows, passage = [], prose(rng, 40, vocabulary)
    for size in (1, 2, 3, 4, 5, 6, 7, 9, 12, 40, 130, 400):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(8):
            rows.append(" ".join(base))
            base = edited(rng, base, max(1, size // 60)).split(" ")  # each of the chain links with its neighbours only
            rows.append(edited(rng, base, rng.randint(0, max(1, size // 20))))
    rows += [prose(rng, 20, vocabulary) + " " + passage + " " + prose(rng, 20, vocabulary) for _ in range(40)]
    rows += [passage.upper(), passage + " x"] + ["same words in all of these rows"] * 9
    rng.shuffle(rows)
    return list(enumerate(rows, 1000))


@pytest.mark.parametrize("members", [J.MEMBERS, 5])
def test_jaccard_components(spark, members):
    rows = corpus() + chains()
    got = J.jaccard_components(frame(spark, rows), members_most=members)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links_tested"]
    assert collections.Counter((r[0], r[1], r[2]) for r in got.collect()) == brute_components(rows)


def test_jaccard_other_threshold_and_large_group(spark):
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(i) for i in range(80)]
    rows = [(i, edited(rng, base, rng.randint(0, 3))) for i in range(150)]
    for percent in (60, 90):
        got = J.jaccard_components(frame(spark, rows), percent=percent, members_most=20)
        assert collections.Counter((r[0], r[1], r[2]) for r in got.collect()) == brute_components(rows, percent)


@pytest.mark.parametrize("members", [2_000, 7])
def test_jaccard_names_a_pair_once(spark, monkeypatch, members):
    """Near copies share many signatures; a pair of them is compared in one of these only."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, edited(rng, base, rng.randrange(3))) for i in range(40)]
    staged, named = J.staged, []

    def seen(df, name):
        out = staged(df, name)
        if name == "jaccard-named":
            named.append([(r["u"], r["v"]) for r in out.collect()])
        return out

    monkeypatch.setattr(J, "staged", seen)
    monkeypatch.setattr(J, "SIGNATURE_WORDS", 1)
    got = J.jaccard_components(frame(spark, rows), members_most=members)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(rows)
    assert named[0] and all(len(set(some)) == len(some) for some in named)


def test_jaccard_rows_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    """Blocks of a bucket are not all dealt to each other: what is compared goes by the members that no link has joined yet."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, base, 1)) for i in range(160)] + [(200 + i, edited(rng, base[:60] + [f"o{i}x{j}" for j in range(60)], 1)) for i in range(5)]
    candidates, seen = J.candidates, []

    def counted(cells, *rest):
        seen.append((cells.count(), cells.select("code", "cell.sig").distinct().count()))
        return candidates(cells, *rest)

    monkeypatch.setattr(J, "candidates", counted)
    got = J.jaccard_components(frame(spark, rows), members_most=10)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(rows)
    assert seen[0][0] == seen[0][1] > 1_000  # a member is once in each of its signatures
    assert sum(n for n, _ in seen) <= 4 * seen[0][0]


def test_jaccard_cells_hold_every_pair_of_different_components(spark):
    """A bucket whose members are in one component is done; else each pair of different ones is in one cell of the last part."""
    of = {c: 0 if c < 60 else c for c in range(90)}
    buckets = spark.createDataFrame([(s, c, 9) for s in (7, 8) for c in of if s == 7 or c < 60], "sig long, code long, blocks long")
    classes = spark.createDataFrame(list(of.items()), "code long, class_id long")
    held = collections.defaultdict(list)
    for r in J.cells_of_rest(buckets, classes, 10).collect():
        held[r["cell"]].append((r["code"], r["side"]))
    met = collections.Counter(frozenset((a, b)) for some in held.values() for i, (a, s) in enumerate(some) for b, t in some[:i] if s == 0 or s != t)
    assert {cell["sig"] for cell in held} == {7}
    assert all(met[frozenset((a, b))] == 1 for a in of for b in range(a) if of[a] != of[b])
    assert not any(of[a] == of[b] for a, b in met)
    first = J.cells_around_first(buckets, classes, 10)
    assert {r[0] for r in first.select("cell.low").collect()} == {0} and first.where("side = 2").select("code").distinct().count() > 60


def test_jaccard_empty(spark):
    assert J.jaccard_components(frame(spark, [])).count() == 0
    got = J.jaccard_components(frame(spark, [(1, None), (2, ""), (None, "a b c d e"), (3, "a b c d e")]))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 0, 1, 0), (2, 0, 2, 0), (3, 2, 3, 0), (None, 2, None, 0)]


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for size in (1, 5, 6, 7, 11, 30, 84, 85, 100, 101, 400, 2500):
        for _ in range(20):
            a = rng.integers(1, 2 ** 63, size, dtype=np.uint64)
            most = 15 * 2 * size // 185  # differing elements of a linked pair of about this size
            drop = int(rng.integers(0, most + 1)) if most else 0
            b = np.concatenate((a[drop:], rng.integers(1, 2 ** 63, int(rng.integers(0, most - drop + 1)), dtype=np.uint64)))
            a, b = np.unique(a), np.unique(b)
            if not J.linked(a, b, 85):
                continue
            sig, of = J.signatures(np.concatenate((a, b)), np.array([len(a), len(b)]))
            assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())
            apart = np.abs(np.diff(J.counted(J.counts(np.concatenate((a, b)), np.array([len(a), len(b)]))).astype(int), axis=0)).sum()
            assert apart <= len(np.setxor1d(a, b))


def test_word_sets():
    long = "v" * 70_000
    texts = [t for _, t in corpus()] + [long, long + "x", "", None, " ", "Q", long]
    elements, sizes = J.word_sets(texts)
    assert sizes.tolist() == [len(shingle_set(t)) for t in texts] and len(elements) == sizes.sum()
    one = [elements[e - 1] for e, t in zip(np.cumsum(sizes).tolist(), texts) if t and t.startswith(long)]
    assert one[0] == one[2] != one[1]


# ------------------------------------------------------------------ hard negatives

def brute_negatives(rows, is_anchor, positives=5, negatives=5, low=80):
    rows = sorted({i: (l, v) for i, l, v in sorted(rows, key=lambda r: (r[0], r[1], r[2]), reverse=True)}.items())
    q = {i: [int(np.floor(256 * float(x))) for x in v] for i, (_, v) in rows}
    label = {i: l for i, (l, _) in rows}
    out = []
    for a in (i for i in q if is_anchor(i)):
        score = {i: max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(q[a], q[i])))) for i in q if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if label[i] == label[a]][:positives]:
            found = [i for i in ranked if label[i] != label[a] and low * score[p] <= 100 * score[i] <= 100 * score[p]][:negatives]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(found)]
    return sorted(out)


def vectors(n=400, width=6, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, width))
    out = []
    for i in range(n):
        v = centres[i % 5] + spread * rng.standard_normal(width)
        out.append((i, int(rng.integers(0, 4)), [float(x) for x in np.float32(v / np.linalg.norm(v))]))
    out += [(n + i, i % 4, out[10][2]) for i in range(60)]  # a common vector: ties
    return out


VECTORS = "vec_id long, label int, embedding array<float>, id string, rank string, number int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], VECTORS).repartition(3)


def mine(spark, rows, every=10, **more):
    return sorted(map(tuple, H.hard_negatives(vector_frame(spark, rows), F.col("vec_id") % every == 0, F.col("label"), **more).collect()))


@pytest.mark.parametrize("block", [H.BLOCK, 7])
def test_hard_negatives(spark, block):
    rows = vectors()
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert mine(spark, rows, block=block) == want and len(want) > 100


def test_hard_negatives_odd_rows(spark):
    rows = vectors(80, 3, 2)
    good = rows + [(500, 1, [0.5]), (510, 1, []), (520, 2, [1.0, 0.0, 0.0, 0.25]), (530, 1, [3e38, 3e38, 1.0]), (540, 2, [3e38, 3e38, 1.0]), (550, 1, [3e38, 3e38, 1.0])]
    bad = [(None, 1, [1.0, 0.0, 0.0]), (600, None, [1.0, 0.0, 0.0]), (610, 1, None), (620, 1, [float("nan"), 0.0, 0.0]), (630, 1, [float("inf"), 0.0, 0.0]),
           (640, 1, [None, 0.0, 0.0]), rows[0], rows[20], (30, 9, [0.0, 1.0, 0.0])]
    got = mine(spark, good + bad)
    assert got == brute_negatives(good, lambda i: i % 10 == 0)
    assert any(s == 2 ** 63 - 1 for *_, s in got)


def test_hard_negatives_none(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) == []  # no anchor
    assert mine(spark, [(0, 0, [1.0]), (2, 1, [1.0])]) == []  # no positive


def test_tree_bounds_spare_scores():
    rng = np.random.default_rng(0)
    centre = 300 * rng.standard_normal((2, 16))
    anchors = np.floor(np.concatenate([c + rng.standard_normal((20, 16)) for c in centre]))
    x = np.floor(np.concatenate([c + 40 * rng.standard_normal((300, 16)) for c in centre]))
    order, parent, edge = tree = H.spanning_tree(anchors)
    assert (parent >= 0).sum() == 39 and all(order.tolist().index(p) < order.tolist().index(i) for i, p in enumerate(parent) if p >= 0)
    assert all(edge[i] == pytest.approx(np.linalg.norm(anchors[i] - anchors[p])) for i, p in enumerate(parent) if p >= 0)
    labels = np.zeros(40, np.int64)
    scores = x @ anchors.T
    lists = [[(int(np.sort(s)[-3]), int(s.max()))] for s in scores.T]
    want = H.Windows(labels, False, lists, 5)
    done = H.sweep(tree, anchors, np.arange(40), want, 1000 + np.arange(600), np.ones(600, np.int64), x)
    assert done < 0.8 * 40 * 600
    for i, s in enumerate(scores.T):
        first = sorted(((-v, 1000 + k) for k, v in enumerate(s.tolist()) if lists[i][0][0] <= v <= lists[i][0][1]))[:5]
        assert want.best[i][0] == [(int(-v), k) for v, k in first]


# ------------------------------------------------------------------ token alignment

def brute_alignment(texts):
    """Per text: groups and linked (a, b) pairs, by byte offsets from the tokens themselves."""
    tok = A.Tokenizers(*PATHS)
    out = []
    for t in texts:
        groups, links = [], []
        a = tok.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tok.b.encode(t) if t else []
        parts_a, parts_b = [tok.bytes_a[i] for i in a], [tok.bytes_b[i] for i in b]
        if not t or b"".join(parts_a) != b" " + t.encode() or b"".join(parts_b) != b" " + t.encode():
            out.append(([], [], [], []))
            continue
        i = j = at_a = at_b = 0
        now_a, now_b = [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                now_a.append(a[i])
                at_a += len(parts_a[i])
                i += 1
            else:
                now_b.append(b[j])
                at_b += len(parts_b[j])
                j += 1
            if at_a == at_b:
                groups.append((now_a, now_b))
                links.append((now_a[-1], now_b[-1]))
                now_a, now_b = [], []
        out.append((a, b, groups, links))
    return out


def alignment_rows(rows):
    found = brute_alignment([t for _, t in rows])
    count = collections.Counter(k for *_, links in found for k in links)
    most = collections.defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (d, _), (a, b, groups, links) in zip(rows, found):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links),
                    hashlib.sha256(said.encode()).hexdigest() if a else "", said if a else ""))
    return collections.Counter(out)


def test_token_alignment(spark, monkeypatch):
    rng = random.Random(8)
    odd = ["▁ literal", "a▁b", "  two  spaces ", "tab\tnew\nline\r\n", "<|endoftext|> and <s> </s> <unk> <0x41>", "日本語 とても 長い", "é é ﬁ №", "😀😀 🏳️‍🌈",
           "x" * 3000, "\x00\x01\x7f", " ", "\n", "null​width﻿", prose(rng, 5000), "1234567 89,0.5", "don't we'll I'm", "a b　c"]
    rows = corpus() + list(enumerate(odd, 2000))
    got = A.align_tokens(frame(spark, rows), *PATHS, with_groups=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert collections.Counter(map(tuple, got.collect())) == alignment_rows(rows)


def test_token_alignment_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(A, "CHUNK_CHARS", 200)  # the functions are pickled with the session's values
    monkeypatch.setattr(A, "BLOCK_CHARS", 100)
    rows = corpus()
    got = A.align_tokens(frame(spark, rows), *PATHS)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter({k[:-1]: n for k, n in alignment_rows(rows).items()})


def test_token_alignment_empty(spark):
    assert A.align_tokens(frame(spark, []), *PATHS).count() == 0
    got = A.align_tokens(frame(spark, [(1, None), (2, "")]), *PATHS).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_are_kept_and_cleared(monkeypatch):
    monkeypatch.setattr(A, "KEPT", 30)
    monkeypatch.setattr(A, "KEPT_CHARS", 6)
    tok = A.Tokenizers(*PATHS)
    assert tok.apart
    pieces, rng = A.Pieces(tok), random.Random(1)
    letters = "ab  \n .,'1é日\u00a0\u3000\x1c\x85"
    for _ in range(60):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 8))] + [None, "longer words stay out of it", "a▁b c"]
        figures, said, links = pieces.align(texts)
        want = brute_alignment(texts)
        assert figures.tolist() == [[len(a), len(b), len(g), len(l)] for a, b, g, l in want]
        assert said == [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g) for _, _, g, _ in want]
        assert links.tolist() == [a * len(tok.bytes_b) + b for *_, l in want for a, b in l]


def test_whole_texts_where_pieces_are_not_safe():
    tok = A.Tokenizers(*PATHS)
    texts = [t for _, t in corpus()]
    apart = A.Pieces(tok).align(texts)
    tok.apart = False
    whole = A.Pieces(tok).align(texts)
    assert (apart[0] == whole[0]).all() and apart[1] == whole[1] and (apart[2] == whole[2]).all()


def test_cuts_with_tokens_without_bytes():
    assert A.cuts([2, 1], [1, 2]) == ([2], [2], [(1, 1)])
    assert A.cuts([2, 0, 1], [2, 1]) == ([2, 3], [1, 2], [(0, 0), (1, 0), (2, 1)])
    assert A.cuts([], []) == ([], [], [])
