"""Threshold-scaled sketches of documents: mergeable fingerprints of very unequal texts.

A text's shingles are its distinct runs of five following words (A-Z in lower case;
a shorter text is one run), hashed to 64 bits. The sketch keeps every hash below a
fixed fraction of the hash space, one in ``SCALE``, so its size follows the text and
two sketches hold the same sample of whatever their texts share: shares of the kept
hashes estimate resemblance, and containment however unequal the texts are. A text
none of whose hashes is below the threshold keeps its least hash; that still merges
(the union's kept hashes, or the least of the least ones), so equal texts have
equal fingerprints and only texts without words have an empty one.

A fingerprint is spelled as its hashes in ascending order, 16 hex digits each.

Each document is also compared with its follower in the order of doc_id. The ids alone
are range-partitioned first; their least ids (one number per ``RANGE_ROWS``
documents, the only thing that is broadcast) deal the texts to ranges in one
exchange, in which the first document of a range also goes to the range before.
Every task then walks its sorted range, holding one document back. Null doc_id comes
first; rows that share a doc_id follow each other by their text. The last document is
followed by the first, a single one by itself. Null texts read as empty; empty texts
and those without words have an empty fingerprint, and two empty ones are alike (1).
An empty table gives an empty result. Texts are read whole. Other columns than
doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnbrook.llm.package import ship

SHINGLE = 5
#: One in so many hashes is kept (a power of two, at most 256).
SCALE = 8
RANGE_ROWS = 4096
DIGITS = 16

#: Fixed value: A-Z become a-z. Words are what stands between the bytes 0x20 and 0x09 to 0x0D, where ``bytes.split`` splits.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _run_hashes(found: list[bytes]) -> list[bytes]:
    """The hash (8 bytes) of each run of ``SHINGLE`` following words, in order; fewer words are one run."""
    line = b" ".join(found)
    if len(found) <= SHINGLE:
        return [hashlib.md5(line, usedforsecurity=False).digest()[:8]] if found else []
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    md5 = hashlib.md5
    return [md5(line[a : b - 1], usedforsecurity=False).digest()[:8] for a, b in zip(starts, ends[SHINGLE - 1 :], strict=False)]


def shingle_hashes(text: str) -> set[bytes]:
    """Hashes of the distinct shingles of a text."""
    return set(_run_hashes(_words(text)))


def _scaled(hashes: set[bytes]) -> frozenset[bytes]:
    kept = frozenset(h for h in hashes if h[0] < 256 // SCALE)
    return kept or frozenset([min(hashes)]) if hashes else kept


def sketch(text: str) -> frozenset[bytes]:
    return _scaled(shingle_hashes(text))


def merge(*sketches: frozenset[bytes]) -> frozenset[bytes]:
    """The sketch of the texts' shingles taken together."""
    return _scaled(set().union(*sketches))


def resemblance(a: frozenset[bytes], b: frozenset[bytes]) -> float:
    """Estimate of the shared part of all shingles of both texts."""
    return len(a & b) / len(a | b) if a or b else 1.0


def containment(a: frozenset[bytes], b: frozenset[bytes]) -> float:
    """Estimate of the part of a's shingles that b has."""
    return len(a & b) / len(a) if a else 1.0


def spell(hashes: frozenset[bytes]) -> str:
    return b"".join(sorted(hashes)).hex()


def hashes_of(fingerprint: Column) -> Column:
    """The hashes in a spelled fingerprint as an array, for use in Spark expressions."""
    return F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def contained(a: Column, b: Column) -> Column:
    """``containment`` of spelled fingerprints as a Spark expression."""
    share = F.size(F.array_intersect(hashes_of(a), hashes_of(b))) / F.size(hashes_of(a))
    return F.when(a == "", 1.0).otherwise(share)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, fingerprint) of every text."""
    ship(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spelled = [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py() or "")
                counts.append(len(hashes))
                spelled.append(spell(_scaled(hashes)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spelled, pa.string())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, fingerprint string")


def merged_hashes(prints: DataFrame, group: str) -> DataFrame:
    """(group, hash): the merged sketch of each group's fingerprints, a row per hash.

    A hash is one row per group however many documents hold it (combined map-side), so
    no group is collected into one task.
    """
    rows = prints.select(group, F.explode(hashes_of(F.col("fingerprint"))).alias("hash")).distinct()
    low = F.lit(f"{256 // SCALE:02x}")
    kept = rows.where(F.col("hash") < low)
    least = rows.groupBy(group).agg(F.min("hash").alias("hash")).where(F.col("hash") >= low)
    return kept.unionByName(least)


def edited_text(text: str, follower: str) -> str:
    """``text`` whose last quarter (of code points, rounded down) is replaced by the beginning of ``follower``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + follower[:cut]


@dataclass
class _Placed:
    doc_id: int | None
    text: str
    runs: list[bytes]
    own: frozenset[bytes]


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("held_in_edited", pa.float64()),
])
REPORT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, held_in_edited double"
)
#: Rows that a task has in hand before it hands them on.
_YIELD_ROWS = 512


def _edited_hashes(at: _Placed, edited: str) -> set[bytes]:
    """Shingles of the edited text; the runs before the cut are those of the text itself."""
    found = _words(edited)
    kept = len(at.text) - len(at.text) // 4
    # The last word before the cut may go on behind it.
    same = max(0, len(_words(at.text[:kept])) - SHINGLE)
    return {*at.runs[:same], *_run_hashes(found[same:])}


def _row(at: _Placed, after: _Placed) -> tuple:
    edited = edited_text(at.text, after.text)
    other = _scaled(_edited_hashes(at, edited))
    return (
        at.doc_id, len(at.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), spell(at.own), spell(other),
        resemblance(at.own, other), resemblance(at.own, after.own), containment(at.own, other),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (range, guest, doc_id, text): each row of a range meets the next one, and the last one the first guest."""
    held, rows = None, []
    for batch in batches:
        for guest, doc_id, text in zip(*(batch.column(c) for c in ("guest", "doc_id", "text")), strict=True):
            if held is None and guest.as_py():
                continue  # a guest after the first of its range
            text = text.as_py() or ""
            runs = _run_hashes(_words(text))
            here = _Placed(doc_id.as_py(), text, runs, _scaled(set(runs)))
            if held is not None:
                rows.append(_row(held, here))
            held = None if guest.as_py() else here
            if len(rows) >= _YIELD_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def range_starts(docs: DataFrame, rows: int = RANGE_ROWS) -> tuple[int | None, list[int]]:
    """(the first id, the least ids of the ranges after the first) of ranges of about ``rows`` documents, by the ids alone."""
    ids = docs.select("doc_id")
    parts = max(1, -(-ids.count() // rows))
    least = ids.repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("lo"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
    starts = sorted({r["lo"] for r in least if r["lo"] is not None})
    if not starts or any(r["nulls"] for r in least):
        return None, starts[1:]
    return starts[0], starts[1:]


def compare_followers(docs: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """Rows ``REPORT``: each document's fingerprint, that of its edited text, and how alike they and the follower's are.

    ``held_in_edited`` is the containment of the text in its edited form.
    """
    spark = docs.sparkSession
    ship(spark)
    first, starts = range_starts(docs, rows)
    bounds = spark.sparkContext.broadcast(np.array(starts, dtype=np.int64))
    last = len(starts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = bounds.value
        for batch in batches:
            ids = batch.column("doc_id")
            null = np.asarray(ids.is_null())
            values = ids.fill_null(0).to_numpy(zero_copy_only=False)
            at = np.where(null, 0, np.searchsorted(edges, values, side="right"))
            leads = null if first is None else ~null & (values == first)
            lead = leads.copy()
            if len(edges):
                lead |= ~null & (at > 0) & (values == edges[np.maximum(at - 1, 0)])
            guests = np.where(leads, last, at - 1)
            chosen = np.flatnonzero(lead)
            order = np.concatenate((np.arange(len(at)), chosen))
            moved = batch.take(pa.array(order)) if len(chosen) else batch
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((at, guests[chosen]))), pa.array(np.arange(len(order)) >= len(at)), moved.column("doc_id"), moved.column("text")],
                names=["range", "guest", "doc_id", "text"],
            )

    placed = docs.select("doc_id", "text").mapInArrow(place, "range long, guest boolean, doc_id long, text string")
    walked = placed.repartitionById(last + 1, F.col("range").cast("int")).sortWithinPartitions("range", "guest", "doc_id", "text")
    return walked.mapInArrow(_walk, REPORT)


def fingerprint_report(docs: DataFrame) -> DataFrame:
    return compare_followers(docs)
