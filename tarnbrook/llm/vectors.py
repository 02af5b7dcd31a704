"""Near-duplicate vectors by lattice hashing: E8 cells, neighbouring cells, exact cosine.

Each table projects the unit vectors to one or more blocks of 8 dimensions at random
and decodes every block to a point of the E8 lattice; the points together are the
cell. A vector is indexed at its own cell and probes it and the ``PROBES`` nearest of
those in which one block's point is one of its 240 neighbours. Vectors that meet are
compared by cosine in double precision; those at or above the limit are links.

The cells' size follows the number of vectors, so that about ``CELL_ROWS`` random rows
are at home in a cell at any number of them: cells shrink, and above some size it is
cheaper to take more blocks. The number of tables follows the cells: pairs of exactly
the limit cosine are drawn at random, and as many tables are taken as bring the
expected share of missed pairs under ``MISS``. Links of a larger cosine are missed
less often still.

Two steps bring vectors together. First go cell, id and a sketch of ``SKETCH`` signs of
random projections: rows in a cell without another row, or where none is at home, go,
and so do rows whose sketch is far from all they could link with (farther than one in
``1 / FAR`` pairs of the limit cosine). What stays is joined to the vectors, brought to
its cell and compared. Both steps emit rows, never pairs.

A pair that meets in several cells is counted in the first one only, which each task
finds from the two vectors. So links are counted where they are found, and what is
emitted is one row per linked vector: its number of links, and a vector it is
connected with. Equal vectors are one class and never compared. Cells with more than
``max(SPLIT_ROWS, rows / 10000)`` rows are cut into blocks, compared block by block
in tasks of their own; there are few of them by that bound (at most
``10000 * (PROBES + 1) * tables``, 24 bytes each, which is what is broadcast), and
their rows skip the sketches. If no vector is at home in such a cell, nothing is sent.

Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing. Only vectors of one length are compared. Rows without vec_id are returned
with no component and link with nothing; rows that share a vec_id are one vector
each. An empty table gives an empty result. Other columns than vec_id and embedding
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product
from math import acos, comb, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbrook.llm.arrays import mix
from tarnbrook.llm.components import connect
from tarnbrook.operators.lookup import find_hot_keys, lookup
from tarnbrook.session import materialize

LIMIT = 0.95
PROBES = 8
CELL_ROWS = 32
MOST_SCALE = 2.0
MOST_BLOCKS = 4
MISS = 1e-4
SKETCH = 128
FAR = 1e-8
SPLIT_ROWS = 1024
SEED = 20
TRIALS = 20_000


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled to be whole: (+-2, +-2, 0...) and (+-1)^8 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-2, 2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((-1, 1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out, dtype=np.int64)


SHORTEST = _shortest()


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """The nearest whole point with an even sum: round, and if the sum is odd turn the coordinate that was rounded furthest."""
    near = np.rint(x)
    odd = near.sum(axis=1).astype(np.int64) % 2 != 0
    off = x - near
    at = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    near[rows, at[rows]] += np.where(off[rows, at[rows]] < 0, -1, 1)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points, doubled to be whole."""
    a, b = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    nearer = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], b, a)).astype(np.int64)


@dataclass
class Lattice:
    """The tables' projections, cell size and blocks to a cell; equal on all workers by the seed."""

    scale: float
    tables: int
    blocks: int = 1
    seed: int = SEED

    def projection(self, table: int, block: int, length: int) -> np.ndarray:
        return np.random.default_rng([self.seed, table, length, block]).standard_normal((length, 8)) / self.scale

    def cells(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Names of the cells that each unit vector probes; its own comes first."""
        own, toward = [], []
        for block in range(self.blocks):
            x = unit @ self.projection(table, block, unit.shape[1])
            own.append(decode_e8(x))
            toward.append((2 * x - own[-1]) @ SHORTEST.T)
        best = np.argpartition(-np.concatenate(toward, axis=1), PROBES - 1, axis=1)[:, :PROBES]
        turned, step = best // len(SHORTEST), SHORTEST[best % len(SHORTEST)]
        name = np.full((len(unit), PROBES + 1), np.uint64(table * 1_000_003 + unit.shape[1]), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for block in range(self.blocks):
                points = np.repeat(own[block][:, None, :], PROBES + 1, axis=1)
                points[:, 1:] += np.where((turned == block)[:, :, None], step, 0)
                for k in range(8):
                    name = mix(name ^ points[:, :, k].view(np.uint64), k)
        return name.view(np.int64)

    def sketch(self, unit: np.ndarray) -> np.ndarray:
        """Signs of random projections, as rows of 64-bit words."""
        length = unit.shape[1]
        signs = unit @ np.random.default_rng([self.seed, length]).standard_normal((length, SKETCH)) > 0
        return np.packbits(signs, axis=1).view(np.int64)


def most_apart(limit: float, far: float = FAR) -> int:
    """The least number of sketch signs by which only a share ``far`` of the pairs of that cosine differ more."""
    p, past, k = acos(max(-1.0, min(1.0, limit))) / pi, 1.0, -1
    while past > far and k < SKETCH:
        k += 1
        past -= comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
    return k


def fitted(rows: int, length: int, limit: float = LIMIT) -> Lattice:
    """Cell size from the number of vectors, number of tables from the cell size, and the number of blocks that needs fewest tables."""
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((TRIALS, length))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((TRIALS, length))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = limit * a + np.sqrt(1 - limit**2) * b
    fits = []
    for blocks in range(1, MOST_BLOCKS + 1):
        # Two projected vectors at random fall in one cell of volume s^8 with probability (4 pi)^-4 s^8, in each block.
        scale = float(min((CELL_ROWS / max(rows, 1)) ** (0.125 / blocks) * (4 * np.pi) ** 0.5, MOST_SCALE))
        one = Lattice(scale, 1, blocks)
        ca, cb = one.cells(a, 0), one.cells(b, 0)
        met = ((ca == cb[:, :1]) | (cb == ca[:, :1])).any(axis=1).mean()
        if met > 0:
            fits.append(Lattice(scale, max(2, int(np.ceil(np.log(MISS) / np.log(1 - met))) if met < 1 else 2), blocks))
        if scale == MOST_SCALE:
            break
    return min(fits, key=lambda fit: (fit.tables, fit.blocks))


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, length, vector bytes) of the usable rows."""
    schema = pa.schema([("vec_id", pa.int64()), ("length", pa.int32()), ("vec", pa.binary())])
    for batch in batches:
        out = []
        for vec_id, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            if not values or None in values:
                continue
            v = np.array(values, dtype=np.float64)
            # Scaled by a power of two, so that no square overflows or vanishes and no digit changes.
            top = np.abs(v).max()
            if np.isfinite(top) and top > 0:
                out.append((vec_id, len(v), np.ldexp(v, -int(np.frexp(top)[1])).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(row numbers, unit vectors, vector bytes) of each vector length in a batch."""
    lengths = batch.column("length").to_numpy()
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        vec = batch.column("vec").take(pa.array(rows))
        yield rows, _unit(vec), vec


_ROWS_AT_ONCE = 4096


def _cell_names(lattice: Lattice):
    schema = pa.schema([("cell", pa.int64()), ("own", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS_AT_ONCE):
                for _, unit, _ in _by_length(whole.slice(at, _ROWS_AT_ONCE)):
                    for t in range(lattice.tables):
                        cells = lattice.cells(unit, t)
                        own = np.zeros(cells.shape, dtype=np.int64)
                        own[:, 0] = 1
                        yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), pa.array(own.ravel())], schema=schema)

    return run


_PROBE = pa.schema([("cell", pa.int64()), ("tab", pa.int32()), ("id", pa.int64()), ("own", pa.bool_()), ("s0", pa.int64()), ("s1", pa.int64())])
PROBE = "cell long, tab int, id long, own boolean, s0 long, s1 long"


def _probes(lattice: Lattice):
    """A row per vector and cell that it probes, with its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS_AT_ONCE):
                batch = whole.slice(at, _ROWS_AT_ONCE)
                ids = batch.column("id").to_numpy()
                for rows, unit, _ in _by_length(batch):
                    sketch, width = lattice.sketch(unit), PROBES + 1
                    s0, s1, number = (np.repeat(c, width) for c in (sketch[:, 0], sketch[:, 1], ids[rows]))
                    own = np.tile(np.arange(width) == 0, len(rows))
                    for t in range(lattice.tables):
                        cells = lattice.cells(unit, t).ravel()
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cells, np.full(len(cells), t, np.int32), number, own, s0, s1)], schema=_PROBE)

    return run


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted rows as tables that cut no run of equal keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = last != tuple(c[0] for c in columns)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        last = tuple(c[-1] for c in columns)
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
            continue
        done = held + ([batch.slice(0, starts[-1])] if starts[-1] else [])
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(starts[-1])]
    if held:
        yield pa.Table.from_batches(held)


_PAIRS_AT_ONCE = 1 << 17


def _small_pairs(start: np.ndarray, size: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, row at home) of all runs, some at a time; in each run the ``home`` rows come first."""
    rows = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(size.cumsum() - size, size)
    first, times = np.repeat(start, size), np.repeat(home, size)
    ends = times.cumsum()
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS_AT_ONCE, side="right")))
        n = times[at:to]
        yield np.repeat(rows[at:to], n), np.repeat(first[at:to], n) + np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
        at = to


def _runs_of(columns: list[np.ndarray], home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, rows at home) of each run of equal keys."""
    new = np.ones(len(home), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, len(home))), np.add.reduceat(home.astype(np.int64), start)


_SKETCHED = 512


def _near_probes(apart: int):
    """The rows that may link in their cell, by sketch; all rows of cut cells and of those with over ``_SKETCHED`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches, ["cell"]):
            s0, s1, ids = (table.column(c).to_numpy().view(np.uint64) for c in ("s0", "s1", "id"))
            own, cut = table.column("own").to_numpy(), table.column("xs").to_numpy() > 0
            start, size, home = _runs_of([table.column("cell").to_numpy()], own)
            stays = cut.copy()
            large = (size > _SKETCHED) & (home > 0) & ~cut[start]
            for a, n in zip(start[large], size[large], strict=True):
                stays[a : a + n] = True
            small = (size <= _SKETCHED) & (size > 1) & (home > 0) & ~cut[start]
            for i, j in _small_pairs(start[small], size[small], home[small]):
                near = (np.bitwise_count(s0[i] ^ s0[j]).astype(np.int16) + np.bitwise_count(s1[i] ^ s1[j]) <= apart) & (ids[i] != ids[j])
                stays[i[near]] = True
                stays[j[near]] = True
            yield from table.select(["cell", "tab", "id", "own", "xs", "ys"]).filter(pa.array(stays)).combine_chunks().to_batches()

    return run


_FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _first_meeting(cells: list[np.ndarray], table: np.ndarray, low: np.ndarray, high: np.ndarray, at_low: np.ndarray) -> np.ndarray:
    """Which pairs of rows (low id, high id), met in ``table``, meet here and in no earlier place.

    ``cells`` has the rows' cells in each table. Places are, table by table, the cell
    of the low one and then that of the high one. ``at_low`` says whether this cell is
    the low one's own.
    """
    meets = lambda names, a, b: (names[b] == names[a, :1]).any(axis=1)
    first = np.full(len(low), 2 * len(cells))
    for t in reversed(range(len(cells))):
        first[meets(cells[t], high, low)] = 2 * t + 1
        first[meets(cells[t], low, high)] = 2 * t
    return first == 2 * table + ~at_low


def _roots(pairs: np.ndarray, count: int) -> np.ndarray:
    """Smallest index reachable over the pairs, for each index below ``count``."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, pairs[:, 0], least)
        np.minimum.at(root, pairs[:, 1], least)
        root = root[root]
        if (root == before).all():
            return root


_BLOCK = 1024
_GATHERED = 1 << 13


def _cell_links(lattice: Lattice, limit: float):
    """Links of the rows of whole cells or blocks. ``left`` rows meet the ``right`` ones, those indexed there, which come first."""

    def near_pairs(unit: np.ndarray, left: np.ndarray, start: np.ndarray, size: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        large = size * home > 16 * _BLOCK
        for a, n, h in zip(start[large], size[large], home[large], strict=True):
            lefts = a + np.flatnonzero(left[a : a + n])
            for at in range(0, len(lefts), _BLOCK):
                part = lefts[at : at + _BLOCK]
                for to in range(a, a + h, _BLOCK):
                    i, j = np.nonzero(unit[part] @ unit[to : min(to + _BLOCK, a + h)].T >= limit)
                    yield part[i], to + j
        for i, j in _small_pairs(start[~large], size[~large], home[~large]):
            for k in range(0, len(i), _GATHERED):
                a, b = i[k : k + _GATHERED], j[k : k + _GATHERED]
                near = left[a] & (np.einsum("ij,ij->i", unit[a], unit[b]) >= limit)
                yield a[near], b[near]

    def run(table: pa.Table) -> pa.Table:
        unit = _unit(table.column("vec").combine_chunks())
        ids, copies, own, left, right, tab = (table.column(c).to_numpy() for c in ("id", "copies", "own", "left", "right", "tab"))
        runs = _runs_of([table.column(c).to_numpy() for c in ("cell", "x", "y")], right)
        links, tied = np.zeros(len(ids), dtype=np.int64), np.zeros((0, 2), dtype=np.int64)
        cells: list[np.ndarray] = []
        for i, j in near_pairs(unit, left, *runs):
            # Two vectors that are both at home here meet twice.
            once = (ids[i] != ids[j]) & (~own[i] | (ids[i] > ids[j]))
            i, j = i[once], j[once]
            if len(i) and not cells:
                cells = [lattice.cells(unit, t) for t in range(int(tab.max()) + 1)]
            for k in range(0, len(i), 1 << 15):
                a, b = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
                low, high = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
                mine = _first_meeting(cells, tab[low], low, high, own[low])
                low, high = low[mine], high[mine]
                np.add.at(links, low, copies[high])
                np.add.at(links, high, copies[low])
                if len(low):
                    root = _roots(np.concatenate((tied, np.stack((low, high), axis=1))), len(ids))
                    tied = np.stack((np.arange(len(ids)), root), axis=1)[root != np.arange(len(ids))]
        named = ids[_roots(tied, len(ids))]
        out = np.flatnonzero(links)
        return pa.table([pa.array(ids[out]), pa.array(links[out]), pa.array(named[out])], schema=_FOUND)

    return run


def _in_cells(links_of):
    """``links_of`` over the whole cells or blocks of sorted rows, those of each vector length apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches, ["length", "cell", "x", "y"]):
            lengths = table.column("length").to_numpy()
            for n in np.unique(lengths):
                yield from links_of(table.filter(pa.array(lengths == n))).combine_chunks().to_batches()

    return run


def _to_blocks(rows: DataFrame) -> DataFrame:
    """Rows of cut cells once for each block (x, y) where they are ``left`` (compared) or ``right`` (compared with); others once."""
    x, y = "pmod(id, xs)", "pmod(xxhash64(id), ys)"
    places = f"""if(xs > 0,
        concat(transform(sequence(0, ys - 1), b -> named_struct('x', int({x}), 'y', b, 'left', true, 'right', own and b = {y})),
               if(own, transform(filter(sequence(0, xs - 1), a -> a <> {x}), a -> named_struct('x', a, 'y', int({y}), 'left', false, 'right', true)), array())),
        array(named_struct('x', 0, 'y', 0, 'left', true, 'right', own)))"""
    return rows.withColumn("place", F.explode(F.expr(places))).select(*[c for c in rows.columns if c not in ("xs", "ys")], "place.*")


def near_vectors(vectors: DataFrame, limit: float = LIMIT, lattice: Lattice | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select("vec_id", "embedding")
    valid = rows.where("vec_id is not null").mapInArrow(_valid, "vec_id long, length int, vec binary")
    valid = materialize(valid, "valid-vectors")
    classes = materialize(valid.groupBy("length", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vector-classes")
    size = classes.agg(F.count("*").alias("n"), F.max("length").alias("length")).first()
    # Classes are told apart by their smallest vec_id; rows that share it, but not the vector, get names of their own.
    if size["n"] != classes.select("id").distinct().count():
        classes = materialize(classes.withColumn("id", F.xxhash64("length", "vec")), "vector-classes")
    lattice = lattice or fitted(size["n"], size["length"] or 8, limit)
    counted = classes.mapInArrow(_cell_names(lattice), "cell long, own long").groupBy("cell").agg(F.count("*").alias("n"), F.sum("own").alias("own"))
    most = max(SPLIT_ROWS, size["n"] // 10_000)
    large = materialize(counted.where(F.col("n") > most).select("cell", *[F.ceil(F.col(c) / most).cast("int").alias(p) for c, p in (("n", "xs"), ("own", "ys"))]), "large-cells")
    probes = classes.mapInArrow(_probes(lattice), PROBE).join(F.broadcast(large), "cell", "left").where("ys is null or ys > 0")
    spread = F.when(F.col("xs") > 0, F.pmod("id", "xs")).otherwise(0)
    dealt = probes.select("*", spread.alias("part")).fillna(0, ["xs", "ys"]).repartition("cell", "part").sortWithinPartitions("cell", F.desc("own"))
    near = materialize(dealt.mapInArrow(_near_probes(most_apart(limit)), "cell long, tab int, id long, own boolean, xs int, ys int"), "near-probes")
    meeting = _to_blocks(near.join(classes, "id")).repartition("cell", "x", "y").sortWithinPartitions("length", "cell", "x", "y", F.desc("right"))
    found = materialize(meeting.mapInArrow(_in_cells(_cell_links(lattice, limit)), "id long, links long, other long"), "vector-links")
    labels = connect(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    placed = classes.join(sums, "id", "left").join(labels, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    members = valid.join(placed, ["length", "vec"]).select("vec_id", "root", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    smallest = members.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = lookup(members, smallest, "root", find_hot_keys(members, ["root"])["root"], ["vec_id"]).select("vec_id", "n_links", "component_id")
    rest = _unusable(rows).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _unusable(rows: DataFrame) -> DataFrame:
    """The rows that ``_valid`` leaves out, and those without vec_id."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    return rows.where(F.col("vec_id").isNull() | ~usable)
