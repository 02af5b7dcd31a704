"""Near-duplicate and repeat operators against plain brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tarnbrook.llm import jaccard, passages
from tarnbrook.llm.components import connect

COLUMNS = "doc_id long, text string, node string, sig string, pack string"
ODD = [None, "", " \n", "one", "One", "two words", "a b c d e", "a b c d e", "A b c d e f", "日本 語 x", "w " * 2000]


def make(spark, texts, ids=None):
    return spark.createDataFrame([(ids[i] if ids else i, t, "x", "x", "x") for i, t in enumerate(texts)], COLUMNS)


def small(spark):
    return [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("text").collect()]


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# Components


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    pairs = {
        "path": [(i, i + 1) for i in range(200)], "star": [(7, i) for i in range(100) if i != 7], "none": [],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
    }[shape]
    out = {r["node"]: r["root"] for r in connect(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert set(out) == nodes
    want = roots(pairs, nodes)
    assert len({(want[n], out[n]) for n in nodes}) == len(set(want.values())) == len(set(out.values()))


# Jaccard


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_similar(texts):
    sets = [shingles(t) for t in texts]
    held = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            held[t].append(i)
    near = {(a, b) for members in held.values() for a in members for b in members if a < b}
    links = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    found = roots(links, range(len(texts)))
    return {i: (len(s), found[i]) for i, s in enumerate(sets)}


def variants(seed, count, length):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randrange(0, max(2, length // 15))):
            words[rng.randrange(length)] = f"x{rng.randrange(9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("often", [1, 8, 256])
def test_jaccard_equals_brute_force(spark, monkeypatch, often):
    """Low limits make most tokens frequent and mix both ways of indexing."""
    monkeypatch.setattr(jaccard, "CLASS_2_FROM", often)
    monkeypatch.setattr(jaccard, "ORDER_FROM", 2)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = ODD + [v for s in range(12) for v in variants(s, 6, 12 + 9 * s)] + [passage + " " + v for v in variants(99, 20, 14)] + [passage + f" tail{i} end{i}" for i in range(20)]
    if often == 256:
        texts += small(spark)
    texts += [v for length in (150, 400, 1500) for v in variants(length, 6, length)]
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_sets(make(spark, texts)).collect()}
    assert out == brute_similar(texts)


def test_jaccard_at_the_limit(spark):
    """3 of 4 shingles link, 74 of 100 do not."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:7]), " ".join(words[:8]), " ".join(words[100:200]), " ".join(words[100:171] + [f"z{i}" for i in range(20)])]
    assert {r["doc_id"]: r["component_id"] for r in jaccard.similar_sets(make(spark, texts)).collect()} == {k: v[1] for k, v in brute_similar(texts).items()}


@pytest.mark.parametrize("longest, frequent", [(90, 344), (90, 600), (900, 344), (900, 600), (4000, 600)])
def test_signatures_meet(longest, frequent):
    """Any two sets that are similar enough share a signature whose places fit; ``frequent`` of 600 tokens are of class 2."""
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(400 if longest < 1000 else 60):
        n = int(rng.integers(3, longest))
        token = np.unique(rng.integers(1, 1 << 60, n).astype(np.uint64))
        # Cut at both ends, or (of subsets) down to three quarters, the largest difference in size.
        cuts = [int(rng.integers(0, len(token) // 8 + 1)) for _ in range(2)] if rng.random() < 0.5 else [len(token) // 4, 0]
        a, b = token[: len(token) - cuts[0]], token[cuts[1] :]
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        times = lambda t: (t % np.uint64(600)).astype(np.int64) + (frequent - 344)
        if 4 * both >= 3 * union and len(a) >= 3 and len(b) >= 3 and union > both:
            x, y = jaccard.signatures(a, times(a)), jaccard.signatures(b, times(b))
            common = np.intersect1d(x[0], y[0])
            fits = [bool(jaccard._fits(len(a), x[1][x[0] == s][0], len(b), y[1][y[0] == s][0])) for s in common]
            assert any(fits)
            assert jaccard.most_shared(jaccard._counts(jaccard.sketch(a)), jaccard._counts(jaccard.sketch(b))) >= both
            met += 1
    assert met > 20


def test_combinations_stay_linear():
    """A set of frequent tokens only has less than 1.6 signatures a token, and none of one token."""
    rng = np.random.default_rng(4)
    for n in (64, 100, 127, 500, 1023, 5000, 20000):
        token = rng.integers(1, 1 << 60, n).astype(np.uint64)
        sig, place = jaccard.signatures(token, np.full(n, 1000))
        assert len(sig) < 1.6 * n and not len(np.intersect1d(sig, token)) and place.min() >= 0


def licensed(count, passage=40, own=9):
    """Texts that share a passage and are too different to link (36 of 54 shingles)."""
    return [" ".join([f"p{i}" for i in range(passage)] + [f"own{k}x{i}" for i in range(own)]) for k in range(count)]


def test_shared_passages_are_told_apart_by_place():
    token = np.arange(1, 37, dtype=np.uint64)
    a, b = (np.concatenate((token, np.arange(k, k + 9, dtype=np.uint64))) for k in (100, 200))
    x, y = (jaccard.signatures(t, np.where(t < 100, 3000, 0)) for t in (a, b))
    common = np.intersect1d(x[0], y[0])
    # Own tokens come first; 45 - 34 + 4 tokens are combined, and one more, in 4 groups.
    in_order = token[: 45 - 34 + 4 + 1 - 9]
    groups = [int(g) for g in jaccard.mix(in_order, 7) & np.uint64(jaccard.token_groups(45) - 1)]
    assert len(common) == sum(groups[i] == groups[j] for i in range(7) for j in range(i)) > 0
    assert not any(jaccard._fits(45, x[1][x[0] == s][0], 45, y[1][y[0] == s][0]) for s in common)


def candidates(spark, monkeypatch, texts):
    """Components, and the number of pairs given out by signatures."""
    counted, real = [], jaccard.crossing

    def counting(*args):
        pairs = real(*args)
        counted.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "crossing", counting)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_sets(make(spark, texts)).collect()}, counted[0]


def test_jaccard_of_a_passage_in_many_texts(spark, monkeypatch):
    """A passage in every text gives no pairs by itself; links among its holders are kept."""
    texts = licensed(600)
    texts += [t + " more" for t in texts[:3]]
    out, pairs = candidates(spark, monkeypatch, texts)
    assert out == brute_similar(texts) and pairs < 100


@pytest.mark.parametrize("split, block", [(1, 3), (4, 7)])
def test_jaccard_in_blocks_equals_brute_force(spark, monkeypatch, split, block):
    monkeypatch.setattr(jaccard, "SPLIT_ROWS", split)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = ODD + licensed(300) + [v for s in range(8) for v in variants(s, 8, 12 + 15 * s)] + [passage + " " + v for v in variants(99, 20, 14)] + [passage + f" tail{i} end{i}" for i in range(300)]
    texts += small(spark)
    out, _ = candidates(spark, monkeypatch, texts)
    assert out == brute_similar(texts)


def test_jaccard_odd_rows(spark):
    text = "a b c d e f g"
    out = jaccard.similar_sets(make(spark, [text, text, text, None], [None, 4, 4, 5])).collect()
    assert sorted(((r["doc_id"] or -1), r["component_id"], r["n_shingles"]) for r in out) == [(-1, None, 3), (4, 4, 3), (4, 4, 3), (5, 5, 0)]
    docs = make(spark, [text, text, text + " h", "other", None], [None, 4, 6, 7, 8])
    kept = jaccard.keep_one_of_each(docs)
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 4, 7, 8] and kept.columns == docs.columns
    assert jaccard.similar_sets(docs.limit(0)).count() == 0


# Passages


def brute_passages(rows):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(d, first.get(key, d))
    out = {}
    for d, w in split:
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        out[d] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("pack", [60, 1 << 20])
def test_passages_equal_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(passages, "PACK_WORDS", pack)
    monkeypatch.setattr(passages, "PACK_BYTES", 8 * pack)
    monkeypatch.setattr(passages, "RANGE_WORDS", 16 * pack)
    passage = " ".join(f"P{i}" for i in range(60))
    cut = [" ".join(f"P{i}" for i in range(k, k + 13)) for k in range(0, 12)]
    texts = [*ODD, *(f"start{i} " * (i % 9) + passage + f" end{i}" for i in range(12)), *(f"a{i} " * i + c + " tail\n" for i, c in enumerate(cut)), " ".join(f"P{i}" for i in range(12))]
    texts += small(spark)
    rows = list(enumerate(reversed(texts)))
    docs = make(spark, list(reversed(texts))).repartition(5)
    found = passages.passage_report(docs).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == brute_passages(rows)


def test_passages_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = passages.drop_repeats(make(spark, [text] * 5, [None, 3, 3, 9, None])).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in rows) == [(-1, 0), (-1, 0), (3, 0), (3, 0), (9, 20)]
    assert [r["repeats"] for r in rows if r["doc_id"] == 9] == [[[0, 20]]] and [r["kept"] for r in rows if r["doc_id"] == 9] == [""]
    assert passages.passage_report(make(spark, ["a"]).limit(0)).count() == 0
