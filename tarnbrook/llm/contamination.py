"""Benchmark decontamination by one Aho-Corasick automaton over normalised items.

Both sides are normalised alike: A-Z in lower case, and every byte that is no
``[0-9a-z]`` and not beyond ASCII ends a word. A window is 13 following words of an
item, or the whole of a shorter one. All windows go into one automaton (spelled
with one space around each word); each document is normalised and scanned once,
and every match is mapped to the words, and through their places to the original
text. Overlapping matches all count.

Spark spells the windows, joins equal ones and sums their bytes: up to
``AUTOMATON_BYTES`` make one automaton; those of a larger benchmark are dealt by hash
to several of about that size, one at a time on the driver, so that neither it nor a
broadcast holds the whole. A task applies them one after the other to ``HELD_BYTES``
of texts, and so builds each automaton once for these and not once a batch.

Null texts have no words and are never hit; an empty table of documents gives an empty
result, an empty benchmark hits nothing. Texts of any length are scanned whole. Rows
are judged one by one, so repeated ones have the same result and a null doc_id is
kept. Items without words have no window. Items are told apart by item_id; items
without one are left out. Other columns than the ids and texts are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbrook.session import materialize

WINDOW = 13
AUTOMATON_BYTES = 16 << 20
HELD_BYTES = 32 << 20

# Fixed value: what each byte becomes; separators become spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def windows(text: str, size: int = WINDOW) -> set[bytes]:
    """The spelled windows of an item."""
    parts = normal_words(text)
    return {b" " + b" ".join(parts[i : i + size]) + b" " for i in range(max(1, len(parts) - size + 1) if parts else 0)}


def _spelled(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
                found = list(windows(text.as_py(), size))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([item] * len(found), pa.int64())], names=["spelled", "item"])

    return run


@lru_cache(1)
def _automaton(shared: Broadcast) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for key, items in shared.value:
        automaton.add_word(key.decode("latin-1"), (key.count(b" ") - 1, items))
    automaton.make_automaton()
    return automaton


def broadcast_windows(benchmark: DataFrame, size: int = WINDOW, limit: int = AUTOMATON_BYTES) -> list[Broadcast]:
    """The windows of all items in parts of about ``limit`` bytes, each to become an automaton."""
    context = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    found = rows.mapInArrow(_spelled(size), "spelled binary, item long").groupBy("spelled").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = materialize(found, "benchmark-windows")
    total = found.agg(F.sum(F.octet_length("spelled") + 8 * F.size("items")).alias("n")).first()["n"] or 0
    parts = -(-total // limit)
    dealt = (found.where(F.pmod(F.xxhash64("spelled"), F.lit(parts)) == k) for k in range(parts))
    return [context.broadcast([(bytes(r["spelled"]), tuple(r["items"])) for r in part.toLocalIterator()]) for part in dealt]


def hit_words(text: str, automata: list[ahocorasick.Automaton]) -> tuple[int, np.ndarray | None, set[int]]:
    """(number of words, which words lie in a window or None, items whose windows occur)."""
    parts = normal_words(text)
    spelled = (b" " + b" ".join(parts) + b" ").decode("latin-1")
    covered, items = None, set()
    for automaton in automata:
        breaks = None
        for end, (size, held) in automaton.iter(spelled):
            if covered is None:
                covered = np.zeros(len(parts), dtype=bool)
            if breaks is None:
                breaks = np.flatnonzero(np.frombuffer(spelled.encode("latin-1"), dtype=np.uint8) == 32)
            last = int(np.searchsorted(breaks, end))
            covered[last - size : last] = True
            items.update(held)
    return len(parts), covered, items


def hit_spans(text: str, covered: np.ndarray | None) -> list[tuple[int, int]]:
    """The covered runs of words as code point spans of the original text."""
    if covered is None or not covered.any():
        return []
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    points = lambda offset: len(raw[:offset].decode("utf-8", "ignore"))
    return [(points(places[a][0]), points(places[b - 1][1])) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _states(texts: list[str], shared: list[Broadcast]) -> list[tuple[int, np.ndarray | None, set[int]]]:
    """``hit_words`` of each text over all automata, one automaton at a time."""
    state = [(0, None, set()) for _ in texts]
    for part in shared or [None]:
        automata = [_automaton(part)] if part else []
        for i, text in enumerate(texts):
            count, covered, items = hit_words(text, automata)
            before = state[i]
            both = covered if before[1] is None else before[1] if covered is None else before[1] | covered
            state[i] = (count, both, before[2] | items)
    return state


def _scanned(batches: Iterator[pa.RecordBatch], shared: list[Broadcast]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, np.ndarray | None, set[int]]]]]:
    """Each batch with the states of its texts; several batches at once where there are several automata."""
    held: list[pa.RecordBatch] = []
    used = 0
    for batch in chain(batches, [None]):
        if batch is not None:
            held.append(batch)
            used += batch.column("text").nbytes
        if held and (batch is None or len(shared) < 2 or used >= HELD_BYTES):
            states = iter(_states([t.as_py() or "" for b in held for t in b.column("text")], shared))
            for b in held:
                yield b, [next(states) for _ in range(b.num_rows)]
            held, used = [], 0


#: A document is contaminated if at least one word in so many is hit.
SHARE = 20


def contaminated(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and SHARE * n_hit >= n_words


FOUND = "doc_id long, n_words long, n_hit long, items array<long>, starts array<long>, ends array<long>"
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: its words, words hit, the items found and the hit spans (code points of the original text)."""
    shared = broadcast_windows(benchmark, size)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, state in _scanned(batches, shared):
            spans = [hit_spans(t.as_py() or "", s[1]) for t, s in zip(batch.column("text"), state, strict=True)]
            columns = [
                [s[0] for s in state], [0 if s[1] is None else int(s[1].sum()) for s in state], [sorted(s[2]) for s in state],
                [[a for a, _ in x] for x in spans], [[b for _, b in x] for x in spans],
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(_FOUND)[1:], strict=True))], schema=_FOUND)

    return docs.select("doc_id", "text").mapInArrow(scan, FOUND)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (all columns) that are not contaminated."""
    shared = broadcast_windows(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, state in _scanned(batches, shared):
            clean = [s[1] is None or not contaminated(s[0], int(s[1].sum())) for s in state]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest columns of ``find_contamination``, and its verdict, per document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["doc_id", "n_words", "n_hit", "items"]).to_pylist()
            for r in rows:
                items = sorted(map(str, r.pop("items")))
                r |= {"n_items": len(items), "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(), "contaminated": contaminated(r["n_words"], r["n_hit"])}
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return find_contamination(docs, benchmark).mapInArrow(report, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
