"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tarnbrook.llm import search

COLUMNS = "doc_id long, text string, n long, score string, item_id string"


def brute_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, best=10):
    held = [(d, brute_terms(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for item, text in set(items):
        if item is not None and brute_terms(text):
            asked[item] = asked.get(item, []) + brute_terms(text)
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, t in held:
            m = 100 - 75 + (75 * len(t) * n) // total
            score = 0
            for x in wanted:
                tf = t.count(x)
                if tf:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, known, doc_id) in enumerate(sorted(scored)[:best], 1):
            out.append((item, rank, doc_id if known else None, -score))
    return sorted(out, key=str)


def compare(spark, docs, items, **options):
    table = spark.createDataFrame([(*d, 0, "clash", "clash") for d in docs], COLUMNS)
    asked = spark.createDataFrame([(*i, "clash", "clash") for i in items], "item_id long, text string, doc_id string, rank string")
    out = search.ranked_search(table, asked, **options).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(docs, items)


def texts(count, seed, words=60):
    pick = random.Random(seed)
    vocabulary = [f"w{int(pick.paretovariate(0.7)) % 400}" for _ in range(400)] + ["Ünï", "日本"]
    return [" ".join(pick.choices(vocabulary, k=pick.randrange(0, words))) for _ in range(count)]


@pytest.mark.parametrize(("rows", "leaf", "block"), [(4096, 16, 1 << 20), (50, 3, 1 << 20), (7, 1, 200)])
def test_ranks_equal_brute_force(spark, monkeypatch, rows, leaf, block):
    """One tree and many, single leaves, several blocks of items; passages and copies among the documents."""
    monkeypatch.setattr(search, "TREE_ROWS", rows)
    monkeypatch.setattr(search, "LEAF_ROWS", leaf)
    items = list(enumerate(texts(12, 2, 40)))
    bodies = texts(220, 1) + [t + " " + more for (_, t), more in zip(items, texts(12, 3), strict=True)] + [texts(1, 9)[0]] * 40
    compare(spark, list(enumerate(bodies)), items, block_bytes=block)


def test_odd_rows(spark):
    docs = [(None, "alpha beta"), (None, None), (3, ""), (4, "ALPHA, beta!"), (4, "ALPHA, beta!"), (5, "-- ** __"), (6, "alpha " * 20_000), (7, "x" * 50_000 + " beta"), (-1, "gamma É")]
    items = [(1, "Alpha"), (1, "beta beta"), (1, "beta beta"), (2, None), (None, "alpha"), (3, ""), (4, "absent"), (5, "é gamma É")]
    compare(spark, docs, items)


def test_ties_go_by_id(spark):
    compare(spark, [(i, "same words here") for i in random.Random(1).sample(range(1000), 50)] + [(2000, "other words")], [(7, "same"), (8, "words")])


def test_empty_tables(spark):
    compare(spark, [], [(1, "a")])
    compare(spark, [(1, "a")], [])
    compare(spark, [(1, None)], [(1, "a")])


def test_driver_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    compare(spark, docs, items)


def _vectors(count, width, seed):
    pick = np.random.default_rng(seed)
    sizes = pick.integers(1, 30, count)
    numbers = np.concatenate([pick.choice(width, s, replace=False) for s in sizes])
    return np.concatenate(([0], np.cumsum(sizes))), numbers, pick.integers(0, 10**10, len(numbers))


def test_bounds_hold_for_every_row_below_a_node():
    starts, numbers, values = _vectors(500, 80, 3)
    scale = np.random.default_rng(4).uniform(0.1, 10, 80)
    tree = search.Tree(starts, numbers, values, scale)
    items = search.pack_items([(i, f"{i} {i + 1} {i * 3 % 80} {i}") for i in range(60)] + [(99, " ".join(map(str, range(80))))])
    order = {int(t): n for t, n in items.vocabulary.items()}
    assert len(order) == 80
    found = search.Search(items, scale)
    dense = np.zeros((500, 80), dtype=object)
    for i in range(500):
        dense[i, numbers[starts[i] : starts[i + 1]]] = values[starts[i] : starts[i + 1]].tolist()
    asked = np.zeros((len(items.ids), 80), dtype=object)
    for i in range(len(items.ids)):
        part = slice(items.starts[i], items.starts[i + 1])
        asked[i, items.numbers[part]] = items.counts[part].tolist()
    scores = dense @ asked.T
    nodes = [tree.root]
    for node in nodes:
        assert (found._bounds(tree, node) >= scores[node.rows].max(axis=0).astype(float)).all()
        nodes += node.children or ()
    assert sum(len(n.rows) for n in nodes if n.children is None) == 500


def test_subtrees_are_left_out():
    """Documents in clusters of few terms: most leaves cannot reach the tenth score."""
    pick = np.random.default_rng(1)
    sizes = np.full(4096, 6)
    numbers = np.concatenate([8 * (i % 64) + pick.choice(8, 6, replace=False) for i in range(4096)])
    tree = search.Tree(np.concatenate(([0], np.cumsum(sizes))), numbers, pick.integers(10**8, 10**9, len(numbers)), np.ones(512))
    items = search.pack_items([(i, " ".join(f"t{n}" for n in range(512)) if i == 0 else f"t{i} t{i + 1}") for i in range(8)])
    found = search.Search(items, tree.scale)
    found.add(tree, list(range(4096)))
    assert found.scored < 0.5 * 4096 * len(items.ids)
