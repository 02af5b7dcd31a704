"""Cells, sketches and sorted runs of the near-vector search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tarnbrook.llm import vectors


def pairs_at(cosine: float, count: int, length: int, seed: int):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((count, length))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((count, length))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    return a, cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)


@pytest.mark.parametrize("rows", [10**6, 10**8, 10**9])
def test_cells_keep_their_occupancy(rows):
    """Random vectors share a cell at the rate that leaves about CELL_ROWS to a cell, with one block or several."""
    lattice = vectors.fitted(rows, 64)
    assert lattice.scale ** (8 * lattice.blocks) / (4 * np.pi) ** (4 * lattice.blocks) * rows <= 1.01 * vectors.CELL_ROWS


def test_tables_grow_slower_than_rows():
    tables = [vectors.fitted(n, 64).tables for n in (10**4, 10**6, 10**8)]
    assert tables == sorted(tables) and tables[2] < 10 * tables[0]


def test_sketches_keep_pairs_of_the_limit():
    a, b = pairs_at(0.95, 50_000, 64, 3)
    lattice = vectors.Lattice(1.5, 1)
    x, y = (lattice.sketch(v).view(np.uint64) for v in (a, b))
    assert (np.bitwise_count(x ^ y).sum(axis=1) <= vectors.most_apart(0.95)).all()
    assert vectors.most_apart(1.0) == 0 and vectors.most_apart(-1.0) == vectors.SKETCH


def test_runs_are_never_cut():
    keys = np.repeat(np.arange(40), np.arange(40) % 7 * 5 + 1)
    batch = pa.table({"cell": keys}).to_batches(max_chunksize=9)
    parts = [t.column("cell").to_numpy() for t in vectors._whole_runs(iter(batch), ["cell"])]
    assert np.concatenate(parts).tolist() == keys.tolist()
    assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False))


def test_pairs_of_runs():
    start, size, home = np.array([0, 5, 6]), np.array([5, 1, 3]), np.array([2, 1, 0])
    got = {(int(i), int(j)) for a, b in vectors._small_pairs(start, size, home) for i, j in zip(a, b, strict=True)}
    assert got == {(i, j) for i in range(5) for j in (0, 1)} | {(5, 5)}
