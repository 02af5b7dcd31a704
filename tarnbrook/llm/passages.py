"""Substring dedup by fixed-block anchors: repeats of 13 words or more leave all but the smallest doc_id.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Any 13 following words hold a whole
block of 7 that starts at a multiple of 7 in its document. So the non-overlapping
blocks of 7 words of all documents are the reference index, and every rolling
window of 7 words of all documents probes it:

1. Documents are packed, about ``PACK_WORDS`` words to a row, and the packs are
   written once.
2. *Anchors.* A pack sends the sorted distinct hashes of its rolling windows to
   ranges of the hash space, with two bits each: is it a block, do several
   documents of the pack hold it. A range answers which hashes are blocks held by
   two documents or more.
3. *Extension.* Around the anchors a pack sends the hashes of the 13-word windows
   (the shortest repeat that counts) with the smallest doc_id that holds each. A
   range answers which are held by a smaller doc_id elsewhere. Neighbouring windows
   that are held join up to maximal exact repeats.
4. The pack's words in such windows go.

Packs send each hash once whatever its copies, so a passage that a third of all
documents share costs a range one entry per pack. Hashes travel as compressed
differences, a few bytes each. A range's size is bounded by choosing their number
from the total of words. Anchors may compare 48 bits (they only choose where to
look); windows compare 64 bits.

A null or empty text has no words. Rows without doc_id are left as they are. Rows
that share a doc_id are one document in what counts as smaller. Other columns than
doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbrook.llm.arrays import SPACED, chunks, grams, whole, words
from tarnbrook.session import materialize

BLOCK = 7
WINDOW = 2 * BLOCK - 1
PACK_WORDS = 1 << 20
PACK_BYTES = 8 << 20
RANGE_WORDS = 1 << 22
ANCHOR_BITS = 48

_PACK = pa.schema([("pack", pa.int64()), ("words", pa.int64()), ("ids", pa.binary()), ("named", pa.binary()), ("offsets", pa.binary()), ("text", pa.binary())])
PACK = "pack long, words long, ids binary, named binary, offsets binary, text binary"


def _squeezed(array: np.ndarray) -> bytes:
    """Compressed by byte planes, as equal planes hold like bytes."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _restored(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(kind).ravel()


def _sorted_bytes(values: np.ndarray) -> bytes:
    return _squeezed(np.diff(values, prepend=np.uint64(0)))


def _sorted_values(data: bytes) -> np.ndarray:
    return np.cumsum(_restored(data, np.uint64), dtype=np.uint64)


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def _flags(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8), count=count).astype(bool)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids: list[np.ndarray] = []
    named: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    texts: list[bytes] = []
    count = size = 0

    def row() -> pa.RecordBatch:
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(lengths)))).astype(np.int64)
        packed = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        cells = [number, count, _squeezed(np.concatenate(ids)), _bits(np.concatenate(named)), _squeezed(offsets), packed]
        for x in (ids, named, lengths, texts):
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, _PACK, strict=True)], schema=_PACK)

    for batch in batches:
        for first, end, data, offsets in chunks(batch, limit=PACK_BYTES // 8):
            column = batch.column("doc_id").slice(first, end - first)
            ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            named.append(column.is_valid().to_numpy(zero_copy_only=False))
            lengths.append(np.diff(offsets))
            texts.append(data.tobytes())
            count += len(words(data, offsets, SPACED).hashes)
            size += len(data)
            if count >= PACK_WORDS or size >= PACK_BYTES:
                yield row()
                number, count, size = number + 1, 0, 0
    if ids:
        yield row()


@dataclass
class Pack:
    """A pack's documents and words; ``doc`` is each word's row."""

    ids: np.ndarray
    named: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    doc: np.ndarray

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, sorted distinct hashes, index among them) of the rolling windows of BLOCK words."""
        at = whole(self.first, BLOCK)
        at = at[self.named[self.doc[at]]]
        value = grams(self.hashes, BLOCK)[at] >> np.uint64(64 - ANCHOR_BITS) if len(at) else np.zeros(0, np.uint64)
        distinct, index = np.unique(value, return_inverse=True)
        return at, distinct, index

    def anchored(self, hot: np.ndarray, at: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, sorted distinct hashes, index among them, smallest doc_id of each) of the WINDOW-word windows that hold an anchor."""
        flags = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        flags[at[hot[index]] + 1] = 1
        upto = np.cumsum(flags)
        start = whole(self.first, WINDOW)
        start = start[upto[start + BLOCK] > upto[start]]
        if not len(start):
            return start, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        distinct, index = np.unique(grams(self.hashes, WINDOW)[start], return_inverse=True)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, index, self.ids[self.doc[start]])
        return start, distinct, index, least


def _open(row: dict) -> Pack:
    offsets = _restored(row["offsets"], np.int64)
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), dtype=np.uint8)
    parts, rows, base = [], len(offsets) - 1, 0
    firsts = [np.zeros(1, np.int64)]
    at = 0
    while at < rows:
        end = min(max(int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1, at + 1), rows)
        w = words(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], SPACED)
        parts.append((w.starts + offsets[at], w.ends + offsets[at], w.hashes))
        firsts.append(w.first[1:] + base)
        base += len(w.hashes)
        at = end
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    first = np.concatenate(firsts)
    ids = _restored(row["ids"], np.int64)
    return Pack(ids, _flags(row["named"], len(ids)), data, starts, ends, hashes, first, np.repeat(np.arange(rows), np.diff(first)))


def _cuts(values: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` (a power of two) equal parts of the hash space begins among sorted values."""
    shift = bits - (ranges.bit_length() - 1)
    return np.searchsorted(values >> np.uint64(shift), np.arange(ranges + 1, dtype=np.uint64))


_PROBE = pa.schema([("part", pa.int32()), ("pack", pa.int64()), ("hashes", pa.binary()), ("block", pa.binary()), ("many", pa.binary())])


def _anchor_rows(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                pack = _open(row)
                at, distinct, index = pack.anchors()
                block = np.zeros(len(distinct), dtype=bool)
                doc = pack.doc[at]
                block[index[(at - pack.first[doc]) % BLOCK == 0]] = True
                low, high = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), -1)
                np.minimum.at(low, index, doc)
                np.maximum.at(high, index, doc)
                many = high > low
                cuts = _cuts(distinct, ANCHOR_BITS, ranges)
                cells = [(p, row["pack"], _sorted_bytes(distinct[a:b]), _bits(block[a:b]), _bits(many[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in cells], f.type) for k, f in enumerate(_PROBE)], schema=_PROBE)

    return run


_REPLY = pa.schema([("pack", pa.int64()), ("step", pa.int32()), ("part", pa.int32()), ("bits", pa.binary())])
REPLY = "pack long, step int, part int, bits binary"


def _reply(table: pa.Table, step: int, index: np.ndarray, lengths: list[int], marked: np.ndarray) -> pa.Table:
    """Each pack's own entries of a range, marked or not."""
    ends = np.cumsum(lengths)
    cells = [_bits(marked[b - n : b]) for b, n in zip(ends, lengths, strict=True)]
    return pa.table([table.column("pack").combine_chunks(), pa.array([step] * len(cells), pa.int32()), table.column("part").combine_chunks(), pa.array(cells, pa.binary())], schema=_REPLY)


def _hot_anchors(table: pa.Table) -> pa.Table:
    values = [_sorted_values(x.as_py()) for x in table.column("hashes")]
    lengths = list(map(len, values))
    block = np.concatenate([_flags(x.as_py(), n) for x, n in zip(table.column("block"), lengths, strict=True)])
    many = np.concatenate([_flags(x.as_py(), n) for x, n in zip(table.column("many"), lengths, strict=True)])
    distinct, index = np.unique(np.concatenate(values), return_inverse=True)
    holders = np.bincount(index, weights=1 + many, minlength=len(distinct))
    hot = (holders >= 2) & (np.bincount(index, weights=block, minlength=len(distinct)) > 0)
    return _reply(table, 0, index, lengths, hot[index])


def _hot_flags(replies: list[dict], step: int, distinct: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """The marks of all ranges, in the order of the pack's sorted hashes."""
    cuts, out = _cuts(distinct, bits, ranges), np.zeros(len(distinct), dtype=bool)
    for r in replies:
        if r["step"] == step:
            a, b = cuts[r["part"]], cuts[r["part"] + 1]
            out[a:b] = _flags(r["bits"], b - a)
    return out


_WINDOW = pa.schema([("part", pa.int32()), ("pack", pa.int64()), ("hashes", pa.binary()), ("least", pa.binary())])


def _window_rows(ranges: int):
    def run(packs: pa.Table, replies: pa.Table) -> pa.Table:
        cells = []
        for row in packs.to_pylist():
            pack = _open(row)
            at, distinct, index = pack.anchors()
            hot = _hot_flags(replies.to_pylist(), 0, distinct, ANCHOR_BITS, ranges)
            _, values, _, least = pack.anchored(hot, at, index)
            cuts = _cuts(values, 64, ranges)
            cells += [(p, row["pack"], _sorted_bytes(values[a:b]), _squeezed(least[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.table([pa.array([c[k] for c in cells], f.type) for k, f in enumerate(_WINDOW)], schema=_WINDOW)

    return run


def _seen_windows(table: pa.Table) -> pa.Table:
    values = [_sorted_values(x.as_py()) for x in table.column("hashes")]
    least = np.concatenate([_restored(x.as_py(), np.int64) for x in table.column("least")])
    distinct, index = np.unique(np.concatenate(values), return_inverse=True)
    smallest = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(smallest, index, least)
    return _reply(table, 1, index, list(map(len, values)), smallest[index] < least)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("repeats", pa.list_(pa.list_(pa.int64()))), ("kept", pa.string())])


def _results(ranges: int, digest: bool):
    def run(packs: pa.Table, replies: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in _RESULT]
        answered = replies.to_pylist()
        for row in packs.to_pylist():
            pack = _open(row)
            at, distinct, index = pack.anchors()
            hot = _hot_flags(answered, 0, distinct, ANCHOR_BITS, ranges)
            start, values, index, least = pack.anchored(hot, at, index)
            gone = np.zeros(len(pack.hashes) + 1, dtype=np.int64)
            if len(start):
                elsewhere = _hot_flags(answered, 1, values, 64, ranges)
                held = start[elsewhere[index] | (pack.ids[pack.doc[start]] > least[index])]
                np.add.at(gone, held, 1)
                np.add.at(gone, held + WINDOW, -1)
            removed = np.cumsum(gone)[:-1] > 0
            raw = pack.data.tobytes()
            for d in range(len(pack.ids)):
                a, b = pack.first[d], pack.first[d + 1]
                mine = removed[a:b]
                kept = b" ".join([raw[s:e] for s, e in zip(pack.starts[a:b][~mine].tolist(), pack.ends[a:b][~mine].tolist(), strict=True)])
                edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.astype(np.int8), [0]))))
                for column, value in zip(
                    columns,
                    [int(pack.ids[d]) if pack.named[d] else None, int(b - a), int(mine.sum()), edges.reshape(-1, 2).tolist(), hashlib.sha256(kept).hexdigest() if digest else kept.decode()],
                    strict=True,
                ):
                    column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _RESULT, strict=True)], schema=_RESULT)

    return run


def drop_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, repeats, kept) per row.

    ``repeats`` are the removed runs as word positions, end exclusive; ``kept`` are
    the other words joined by a space, or with ``digest`` the SHA-256 of that.
    """
    packs = materialize(docs.select("doc_id", "text").mapInArrow(_packs, PACK), "packs")
    total = packs.agg(F.sum("words")).first()[0] or 0
    ranges = 1 << max(4, int(-(-total // RANGE_WORDS) - 1).bit_length())
    probes = packs.mapInArrow(_anchor_rows(ranges), "part int, pack long, hashes binary, block binary, many binary")
    hot = materialize(probes.groupBy("part").applyInArrow(_hot_anchors, REPLY), "anchors")
    windows = packs.groupBy("pack").cogroup(hot.groupBy("pack")).applyInArrow(_window_rows(ranges), "part int, pack long, hashes binary, least binary")
    seen = materialize(windows.groupBy("part").applyInArrow(_seen_windows, REPLY), "windows")
    replies = hot.unionByName(seen)
    return packs.groupBy("pack").cogroup(replies.groupBy("pack")).applyInArrow(
        _results(ranges, digest), "doc_id long, n_words long, n_removed long, repeats array<array<long>>, kept string"
    )


def passage_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row."""
    return drop_repeats(docs, digest=True).select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
