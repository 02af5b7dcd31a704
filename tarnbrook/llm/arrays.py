"""Arrow batches as numpy arrays: bounded chunks of text, words and their hashes.

A chunk is a run of whole rows of one Arrow batch holding at most ``CHUNK_BYTES``
of text (a longer text is a chunk of its own), so that a task's arrays stay
bounded however many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: equal values stay equal, others are spread evenly."""
    x = values + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _S30)) * _MIX_A
    x = (x ^ (x >> _S27)) * _MIX_B
    return x ^ (x >> _S31)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows end to end, and the rows' offsets in them; null reads as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, dtype=np.uint8)[offsets[0] : offsets[-1]] if whole is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each chunk of a batch."""
    if not batch.num_rows:
        return
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), batch.num_rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def byte_table(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, what a byte reads as), with A-Z read as a-z if ``lower``."""
    inside = np.ones(256, dtype=bool)
    inside[list(separators)] = False
    read = np.arange(256, dtype=np.uint8)
    if lower:
        read[65:91] += 32
    return inside, read


SPACE = bytes([0x20, 9, 10, 11, 12, 13])
SPACED = byte_table(SPACE, lower=False)
SPACED_LOWER = byte_table(SPACE, lower=True)


@dataclass
class Words:
    """Words of a chunk: byte range, 64-bit hash, and where each row's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of length rows + 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_KEPT = np.array([(1 << 8 * k) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
_STEP, _LENGTH = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def word_hashes(read: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range of ``read``: its 8-byte blocks, mixed each with its place, and its length.

    Every block goes through the finaliser before the blocks are added up, so no
    arrangement of letters cancels out.
    """
    padded = np.concatenate((read, np.zeros(8, dtype=np.uint8)))
    block_at = np.ndarray(len(read) + 1, dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    with np.errstate(over="ignore"):
        sums = mix((block_at[starts] & _KEPT[np.minimum(lengths, 8)]) + _STEP)
        long = np.flatnonzero(lengths > 8)
        if len(long):
            more = (lengths[long] - 1) >> 3
            offsets = np.cumsum(more) - more
            place = np.arange(int(more.sum())) - np.repeat(offsets, more) + 1
            left = np.repeat(lengths[long], more) - 8 * place
            block = block_at[np.repeat(starts[long], more) + 8 * place] & _KEPT[np.minimum(left, 8)]
            sums[long] += np.add.reduceat(mix(block + _STEP * (place + 1).astype(np.uint64)), offsets)
        return mix(sums + lengths.astype(np.uint64) * _LENGTH)


def word_places(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and their number) of the maximal runs of word bytes that do not cross a row."""
    mask = inside[data]
    n = len(data)
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    row_starts = offsets[:-1][offsets[:-1] < n]
    begins[row_starts] = mask[row_starts]
    stops = np.zeros(n + 1, dtype=bool)
    stops[1:n] = mask[:-1] & ~mask[1:]
    if n:
        stops[n] = mask[-1]
        inner = row_starts[row_starts > 0]
        stops[inner] = mask[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> Words:
    """The words of a chunk with their hashes."""
    inside, read = table
    starts, ends, first = word_places(data, offsets, inside)
    if not len(starts):
        return Words(starts, ends, np.zeros(0, np.uint64), first)
    return Words(starts, ends, word_hashes(read[data], starts, ends), first)


_ODD = mix(np.arange(64, dtype=np.uint64), 7) | np.uint64(1)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` following words (runs may cross rows; see ``whole``)."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(count, dtype=np.uint64)
        for k in range(size):
            out += hashes[k : k + count] * _ODD[k]
        return mix(out, size)


def whole(first: np.ndarray, size: int) -> np.ndarray:
    """Start positions of the runs of ``size`` words that lie in one row."""
    total = int(first[-1])
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.arange(total)
    return starts[starts + size <= first[1:][rows]]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total) + shift
