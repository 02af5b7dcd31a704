"""Vectors and language-model scores against brute force and plain loops."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tarnbrook.llm import scoring, vectors
from tarnbrook.llm.arrays import text_bytes

# Vectors


def brute_near(rows):
    """rows: (vec_id, list or None)."""
    good = [(i, np.array(v, float) / np.abs(np.array(v, float)).max()) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, root = Counter(), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i, _ in rows}


def clusters(seed, groups, members, noise, length=64):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = rng.standard_normal(length)
        out += [(base + noise * rng.standard_normal(length)).astype(np.float32).astype(float).tolist() for _ in range(members)]
    return out


@pytest.mark.parametrize("split", [4096, 40])
def test_vectors_equal_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(vectors, "SPLIT_ROWS", split)
    odd = [None, [], [0.0] * 64, [1.0] * 63 + [None], [1.0] * 63 + [float("nan")], [1.0] * 63 + [float("inf")], [1.0, 0.0], [2.0, 0.01], [1e-300] * 64, [1e300] * 64]
    near = clusters(1, 1, 150, 0.12)
    values = odd + near + clusters(2, 20, 4, 0.2) + clusters(3, 200, 1, 0) + near[:3] * 5
    ids = list(range(len(values)))
    np.random.default_rng(7).shuffle(ids)
    rows = [(int(i), v) for i, v in zip(ids, values, strict=True)]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, cell string")
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(table).collect()}
    assert out == brute_near(rows)


def test_vectors_of_the_driver_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(table).collect()}
    assert out == brute_near([(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_cells_without_a_vector_at_home(spark, monkeypatch):
    """Many vectors that probe a cell where none is at home are not sent there."""
    most = 64
    monkeypatch.setattr(vectors, "SPLIT_ROWS", most)
    real = vectors._cell_links

    def watched(lattice, limit):
        run = real(lattice, limit)

        def small(table):
            if table.num_rows > most and not any(table.column("right").to_pylist()):
                raise ValueError(f"{table.num_rows} rows in a cell without pairs")
            return run(table)

        return small

    monkeypatch.setattr(vectors, "_cell_links", watched)
    rows = list(enumerate(clusters(4, 1, 300, 0.01) + clusters(5, 100, 1, 0)))
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == brute_near(rows)


def test_odd_vector_rows(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0])]
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(((r["vec_id"] or 0), r["n_links"], r["kept"]) for r in out) == [(0, 0, False), (1, 0, True), (1, 1, True), (1, 1, True)]


def test_e8_decoder():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8)) * 2
    own = vectors.decode_e8(x)
    assert ((own % 2 == 0).all(axis=1) | (own % 2 == 1).all(axis=1)).all() and (own.sum(axis=1) % 4 == 0).all()
    away = ((2 * x - own) ** 2).sum(axis=1)
    assert away.max() <= 4 + 1e-9
    others = own[:, None, :] + vectors.SHORTEST
    assert (((2 * x[:, None, :] - others) ** 2).sum(axis=2) >= away[:, None] - 1e-9).all()
    assert len(vectors.SHORTEST) == 240 and ((vectors.SHORTEST**2).sum(axis=1) == 8).all()


@pytest.mark.parametrize("rows", [1000, 50_000, 10**7])
def test_recall_at_the_limit(rows):
    """New random pairs of exactly the limit cosine meet, by the tables that were fitted."""
    lattice = vectors.fitted(rows, 64)
    rng = np.random.default_rng(99)
    a = rng.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((20_000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = np.zeros(len(a), bool)
    for t in range(lattice.tables):
        ca, cb = lattice.cells(a, t), lattice.cells(b, t)
        met |= ((ca == cb[:, :1]) | (cb == ca[:, :1])).any(axis=1)
    assert met.mean() > 0.999


# Language model


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(rows):
    trained = [(d, t) for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    counts = Counter()
    for _, t in trained:
        counts.update([*words_of(t), None])
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        toks = [*words_of(t), None]
        out[d] = (zlib.crc32(str(d).encode()) % 7 == 2, len(toks), sum(counts[x] > 0 for x in toks), total, sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in toks))
    return out


@pytest.mark.parametrize("common", [1 << 18, 50])
def test_base_scores_equal_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(scoring, "COMMON", common)
    texts = [None, "", " \n", "É É é THE the", "w " * 500]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, row string, token string")
    want = brute_base(rows)
    out = {r["doc_id"]: r for r in scoring.score_documents(docs).collect()}
    assert set(out) == set(want)
    for d, w in want.items():
        r = out[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], abs=1e-6) and math.isfinite(r["score"])
    held = [r for r in out.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_tables_without_training_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    out = scoring.score_documents(docs).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [(0, 0, 0.0)] * 2
    assert scoring.score_documents(docs.limit(0)).count() == 0


def test_state_is_carried_through_whole_rows():
    w = scoring.fresh_weights()
    rng = np.random.default_rng(2)
    counts = np.array([3, 1, 40, 7])
    kinds = rng.integers(0, scoring.CLASSES, counts.sum()).astype(np.int16)
    got = scoring.class_scores(w, kinds, counts)
    at = 0
    for k, n in enumerate(counts):
        h, read, total = np.zeros((1, scoring.HIDDEN), np.float32), scoring.END, 0.0
        for c in kinds[at : at + n]:
            h = scoring._step(w, h, np.array([read]))[0]
            total += float(scoring._log_share(w, h)[0, c])
            read = int(c)
        at += n
        assert got[k] == pytest.approx(total / math.log(10), rel=1e-4)


def test_gradients_equal_differences():
    w = {k: v.astype(np.float64) for k, v in scoring.fresh_weights().items()}
    rng = np.random.default_rng(4)
    read, want = rng.integers(0, scoring.CLASSES, (3, 6)), rng.integers(0, scoring.CLASSES, (3, 6))
    h = rng.standard_normal((3, scoring.HIDDEN)) * 0.1
    grad = scoring.gradients(w, h, read, want)[0]
    for k in w:
        for place in rng.integers(0, w[k].size, 4):
            sides = []
            for step in (1e-5, -1e-5):
                other = {n: v.copy() for n, v in w.items()}
                other[k].reshape(-1)[place] += step
                sides.append(scoring.gradients(other, h, read, want)[2] / want.size)
            assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(grad[k].reshape(-1)[place], abs=1e-6)


def test_training_helps():
    kinds = np.tile(np.array([1, 2, 3, 4, 5, 0], dtype=np.int16), 4000)
    w = scoring.fresh_weights()
    before = scoring.class_scores(w, kinds[:60], np.full(10, 6)).sum()
    scoring.train(w, kinds, 0.01)
    assert scoring.class_scores(w, kinds[:60], np.full(10, 6)).sum() > 0.2 * before


def test_tokens_of_a_chunk():
    import pyarrow as pa

    hashes, kinds, counts = scoring.tokens(*text_bytes(pa.array(["A b", None, "b"])))
    assert counts.tolist() == [3, 1, 2] and (kinds == 0).tolist() == [False, False, True, True, False, True]
    assert hashes[1] == hashes[4] != hashes[0]
