"""Ranked lexical search: the best documents of every item, by a ball tree over sparse vectors.

A document is a vector over the items' terms: weight of the term times the document's
saturated term frequency, both whole numbers, so the score of an item is the inner
product of that vector with the item's term counts. ``Stats`` (numbers of documents
and terms, and in how many documents each of the items' terms occurs) come from all
documents; texts are read once, whole, and become written rows of term numbers.

Each task puts its rows into trees of ``TREE_ROWS`` documents. A node's documents go
to the nearer of two centres (from two far ones, a few rounds), and a node has its
centroid (sparse) and radius. For an item q no document below a node scores more
than <q, centroid> + |q'| * radius, where q' are the item's terms that the centroid
has: documents below the node have no others. Terms are scaled for the geometry
(``scales``), which leaves the product of item and document alone but evens out what
a term adds to both factors. Bounds are raised by ``SLACK`` so that no rounding can
make them too small. Items search best-first: the node with the highest bound is
opened next, and when it is below the item's tenth score the rest of the tree is
left out. At leaves, scores are exact 64-bit integers. A task carries the
tenth scores from tree to tree and returns each item's best rows; the best of those
(rank windows that forward ten rows an item from every task) are the result.

Items are dealt into blocks of about ``BLOCK_BYTES`` of text; a block's terms are on
the driver and broadcast, and every block meets all documents. Rows that share an
item_id are one item, with equal rows counted once; items without an id or without
terms have no result. A null doc_id comes before others among equal scores; repeated
rows are documents of their own. Null and empty texts have no terms and do not count
for N. An empty table of documents or items gives an empty result. Other columns than
ids and texts are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnbrook.llm.package import ship
from tarnbrook.session import materialize

BEST = 10
BLOCK_BYTES = 4 << 20
TREE_ROWS = 4096
#: A tree is closed early when its documents hold so many entries.
TREE_ENTRIES = 4 << 20
LEAF_ROWS = 8
#: Rounds of moving rows to the nearer of two centres, and the least share (one in so many) of the rows on each side.
ROUNDS = 3
SHARE = 16
SLACK = 1e-9

#: Fixed value: what each byte becomes; separators become spaces, A-Z becomes a-z.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


# Statistics and weights


@dataclass(frozen=True)
class Items:
    """A block of items: their term numbers and counts, end to end."""

    ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray  # of length items + 1
    numbers: np.ndarray
    counts: np.ndarray


def pack_items(rows: list[tuple[int, str]]) -> Items:
    vocabulary: dict[bytes, int] = {}
    held: dict[int, Counter] = {}
    for item, text in rows:
        found = Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms(text))
        if found:
            held.setdefault(item, Counter()).update(found)
    ids = sorted(held)
    sizes = [len(held[i]) for i in ids]
    numbers = np.array([n for i in ids for n in held[i]], dtype=np.int64)
    counts = np.array([c for i in ids for c in held[i].values()], dtype=np.int64)
    return Items(ids, vocabulary, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), numbers, counts)


@dataclass(frozen=True)
class Stats:
    documents: int
    terms: int
    holding: np.ndarray  # documents with the term, by term number

    @cached_property
    def weights(self) -> np.ndarray:
        return np.array([weight(self.documents, int(h)) for h in self.holding], dtype=np.int64)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def measure(length: np.ndarray, stats: Stats) -> np.ndarray:
    return 100 - 75 + (75 * length * stats.documents) // stats.terms


def entries(length: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, often: np.ndarray, stats: Stats) -> np.ndarray:
    """Vector entries (int64): weight of the term times its share in the document."""
    m = np.repeat(measure(length, stats), sizes)
    return stats.weights[numbers] * ((1_000_000_000 * often) // (1000 * often + 8 * m))


def scales(items: Items, stats: Stats) -> np.ndarray:
    """Factor of each term in the trees' geometry: documents are multiplied by it and items divided.

    It balances how much a term adds, on average, to an item's norm and to a
    radius. Any positive numbers give the same results.
    """
    asked = np.bincount(items.numbers, minlength=len(items.vocabulary)) / max(len(items.ids), 1)
    share = (stats.holding + 0.5) / (stats.documents + 1)
    return asked**0.25 / np.sqrt(np.maximum(stats.weights, 1) * np.sqrt(share * (1 - share) + SLACK))


# Trees


@dataclass
class Node:
    rows: np.ndarray
    at: np.ndarray  # term numbers of the centroid
    centre: np.ndarray  # its values, in floats
    radius: float
    children: tuple[Node, Node] | None = None
    bounds: np.ndarray | None = None
    leaf: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


@dataclass
class Tree:
    """A ball tree over sparse rows: ``numbers[starts[i]:starts[i + 1]]`` are the terms of row i."""

    starts: np.ndarray
    numbers: np.ndarray
    values: np.ndarray
    scale: np.ndarray
    scratch: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.scratch = np.zeros(len(self.scale))
        self.root = self._grow(np.arange(len(self.starts) - 1)) if len(self.starts) > 1 else None

    def _gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, values, offsets) of some rows, end to end."""
        lengths = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(lengths)
        offsets = ends - lengths
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - offsets, lengths)
        return self.numbers[at], self.values[at], offsets

    def _grow(self, rows: np.ndarray) -> Node:
        """Every row has at least one entry; a node of equal rows is a leaf however many they are."""
        numbers, values, offsets = self._gather(rows)
        real = values * self.scale[numbers]
        sums = np.bincount(numbers, weights=real, minlength=0) / len(rows)
        at = np.flatnonzero(sums)
        centre = sums[at]
        squares = np.add.reduceat(real * real, offsets)

        def away(point_at: np.ndarray, point: np.ndarray) -> np.ndarray:
            """Squared distance of each row to a sparse point."""
            self.scratch[point_at] = point
            dots = np.add.reduceat(real * self.scratch[numbers], offsets)
            self.scratch[point_at] = 0.0
            return np.maximum(squares + float(point @ point) - 2.0 * dots, 0.0)

        def row(i: int) -> tuple[np.ndarray, np.ndarray]:
            part = slice(offsets[i], offsets[i + 1] if i + 1 < len(offsets) else None)
            return numbers[part], real[part]

        apart = away(at, centre)
        # What cancels in a squared distance is far below SLACK of the squares themselves.
        radius = math.sqrt(float(apart.max()) + SLACK * float(squares.max() + centre @ centre))
        node = Node(rows, at, centre, radius)
        far = int(apart.argmax())
        from_far = away(*row(far))
        if len(rows) <= LEAF_ROWS or not from_far.any():
            node.leaf = (numbers, values, offsets)
            return node
        nearer = from_far < away(*row(int(from_far.argmax())))
        for _ in range(ROUNDS):
            left = np.repeat(nearer, np.diff(np.append(offsets, len(numbers))))
            sides = []
            for side, count in ((left, nearer.sum()), (~left, (~nearer).sum())):
                sums = np.bincount(numbers[side], weights=real[side]) / max(int(count), 1)
                held = np.flatnonzero(sums)
                sides.append(away(held, sums[held]))
            lean = sides[0] - sides[1]
            nearer = lean < 0
        few = max(1, len(rows) // SHARE)
        if not few <= nearer.sum() <= len(rows) - few:
            order = np.argsort(lean, kind="stable")
            nearer = np.zeros(len(rows), dtype=bool)
            nearer[order[: few if nearer.sum() < few else len(rows) - few]] = True
        node.children = (self._grow(rows[nearer]), self._grow(rows[~nearer]))
        return node


class Search:
    """The best rows of every item so far, over any number of trees."""

    def __init__(self, items: Items, scale: np.ndarray, best: int = BEST):
        self.items, self.best = items, best
        self.found: list[list[tuple[int, int, int]]] = [[] for _ in items.ids]
        self.real = items.counts / scale[items.numbers]
        self.squares = self.real**2
        self.opened = self.scored = 0

    def _bounds(self, tree: Tree, node: Node) -> np.ndarray:
        """For every item, a score that no row below the node exceeds; computed when the node is first met."""
        if node.bounds is None:
            tree.scratch[node.at] = node.centre
            centre = tree.scratch[self.items.numbers]
            tree.scratch[node.at] = 0.0
            dots = np.add.reduceat(centre * self.real, self.items.starts[:-1])
            norms = np.sqrt(np.add.reduceat(self.squares * (centre > 0), self.items.starts[:-1]))
            node.bounds = (dots + norms * node.radius) * (1.0 + SLACK) + 1.0
        return node.bounds

    def add(self, tree: Tree, ids: list[int | None]) -> None:
        if tree.root is None:
            return
        dense = np.zeros(len(tree.scale), dtype=np.int64)
        for item in range(len(self.items.ids)):
            part = slice(self.items.starts[item], self.items.starts[item + 1])
            dense[self.items.numbers[part]] = self.items.counts[part]
            self._best_first(tree, item, dense, ids)
            dense[self.items.numbers[part]] = 0

    def _best_first(self, tree: Tree, item: int, dense: np.ndarray, ids: list[int | None]) -> None:
        held, opened = self.found[item], 0
        queue = [(-self._bounds(tree, tree.root)[item], 0, tree.root)]
        while queue:
            bound, _, node = heapq.heappop(queue)
            # Equal scores count: the smaller doc_id wins.
            if len(held) == self.best and -bound < held[0][0]:
                return
            self.opened += 1
            if node.leaf is None:
                for child in node.children:
                    opened += 1
                    heapq.heappush(queue, (-self._bounds(tree, child)[item], opened, child))
                continue
            numbers, values, offsets = node.leaf
            scores = np.add.reduceat(values * dense[numbers], offsets)
            self.scored += len(scores)
            least = held[0][0] if len(held) == self.best else 1
            for i in np.flatnonzero(scores >= max(least, 1)):
                doc_id = ids[node.rows[i]]
                entry = (int(scores[i]), doc_id is None, -(doc_id or 0))
                if len(held) < self.best:
                    heapq.heappush(held, entry)
                elif entry > held[0]:
                    heapq.heapreplace(held, entry)

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, held in zip(self.items.ids, self.found, strict=True):
            for score, null, negated in held:
                yield item, None if null else -negated, score


# Spark jobs

_FORWARD = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("numbers", pa.list_(pa.int32())), ("often", pa.list_(pa.int32()))])


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, numbers, often): length of each document with terms, and its counts of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                found = terms(text.as_py() or "")
                if not found:
                    continue
                counts = Counter(known[t] for t in found if t in known)
                for column, value in zip(columns, (doc_id.as_py(), len(found), list(counts), list(counts.values())), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FORWARD, strict=True)], schema=_FORWARD)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, numbers array<int>, often array<int>")


def statistics(forward: DataFrame, words: int) -> Stats:
    """N, L and the weight of each of the block's terms; at most one row a term comes to the driver."""
    totals = forward.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    holding = np.zeros(words, dtype=np.int64)
    for r in forward.select(F.explode("numbers").alias("t")).groupBy("t").count().toLocalIterator():
        holding[r["t"]] = r["count"]
    return Stats(totals["n"], totals["l"], holding)


def search_rows(forward: DataFrame, items: Items, stats: Stats, best: int = BEST) -> DataFrame:
    """(item_id, doc_id, score): every task's best rows of every item."""
    shared = forward.sparkSession.sparkContext.broadcast((items, stats))
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known = shared.value
        scale = scales(block, known)
        search = Search(block, scale, best)
        for ids, lengths, sizes, numbers, often in _trees(batches):
            values = entries(lengths, sizes, numbers, often, known)
            tree = Tree(np.concatenate(([0], np.cumsum(sizes))), numbers, values, scale)
            search.add(tree, ids)
        rows = list(search.rows())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], schema=schema)

    return forward.where(F.size("numbers") > 0).mapInArrow(run, "item_id long, doc_id long, score long")


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows, each for one tree of bounded size: (ids, lengths, entries a row, term numbers, counts)."""
    ids: list = []
    parts: tuple[list, ...] = ([], [], [], [])
    rows = held = 0

    def whole():
        return ids, *(np.concatenate(p) for p in parts)

    for batch in batches:
        starts = batch.column("numbers").offsets.to_numpy()
        starts = starts - starts[0]
        flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("numbers", "often")]
        lengths, doc_ids = batch.column("n").to_numpy(zero_copy_only=False), batch.column("doc_id").to_pylist()
        first = 0
        while first < batch.num_rows:
            fits = int(np.searchsorted(starts, starts[first] + TREE_ENTRIES - held, side="right")) - 1
            end = min(max(first + 1, fits), first + TREE_ROWS - rows, batch.num_rows)
            span = slice(starts[first], starts[end])
            ids += doc_ids[first:end]
            for part, values in zip(parts, (lengths[first:end], np.diff(starts[first : end + 1]), flat[0][span], flat[1][span]), strict=True):
                part.append(values.astype(np.int64))
            rows, held, first = rows + end - first, held + int(starts[end] - starts[first]), end
            if rows >= TREE_ROWS or held >= TREE_ENTRIES:
                yield whole()
                ids, parts, rows, held = [], ([], [], [], []), 0, 0
    if rows:
        yield whole()


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of every item, highest score first, then by doc_id."""
    spark = docs.sparkSession
    ship(spark)
    asked = items.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        block = pack_items([(r["item_id"], r["text"]) for r in rows])
        if not block.ids:
            continue
        forward = materialize(forward_rows(docs, block.vocabulary), "search-forward")
        stats = statistics(forward, len(block.vocabulary))
        found = found.unionByName(search_rows(forward, block, stats, best))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
