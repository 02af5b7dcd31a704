"""Language identification with language-bitmask n-gram filters.

Text is normalised (letters in lower case, all else one space) and cut into 4-byte
n-grams of its UTF-8 form. Training counts the n-grams of each language over all
training texts; a language holds an n-gram if the n-gram makes up at least
``LEAST_SHARE`` of the language's n-grams, and at least ``LEAST_RATIO`` of its
share in the language where it is most common. The share bounds what a language can
hold (1 / LEAST_SHARE n-grams), so the model has a fixed size whatever the corpus.

The model is a bit-sliced Bloom filter: each slot is a mask with one bit per
language. The AND of an n-gram's slots gives all languages that hold it. Summing the
bits per language over a text gives hits; with n n-grams and a false positive rate f
of the language's slice, (hits / n - f) / (1 - f) estimates the share of n-grams
that the language really holds. The language with the largest estimate wins, ties
go to the smaller name, and the estimate is the score.

Only text and lang are learned from. A null text, or one without letters, is
``und`` with score 0. A text too short for an n-gram of any language gets the most
common language with score 0. Without training rows every text is ``und``.
Other columns than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnbrook.llm.arrays import chunks, mix
from tarnbrook.session import materialize

SIZE = 4
SLOTS = 1 << 20
HASHES = 4
LEAST_SHARE = 1e-5
LEAST_RATIO = 0.1
FOLDS = 5
UNKNOWN = "und"

#: Letters are the characters of Unicode category L.
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram as an integer, row) of all n-grams of a chunk; none crosses a row."""
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    # One space before and after each row.
    bounds = offsets + 2 * np.arange(rows + 1)
    folded = np.full(int(bounds[-1]), 32, dtype=np.uint8)
    inner = np.ones(len(folded), dtype=bool)
    inner[bounds[:-1]] = False
    inner[bounds[1:] - 1] = False
    folded[inner] = _FOLD[data]
    # Capital letters of the second block of Latin letters become small ones.
    capital = (folded[:-1] == 0xC3) & (folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (folded[1:] != 0x97)
    folded[1:][capital] += 0x20
    # Runs of spaces become one.
    keep = np.ones(len(folded), dtype=bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    keep[bounds[:-1]] = True
    row = np.repeat(np.arange(rows), lengths + 2)[keep]
    folded = folded[keep].astype(np.uint64)
    count = len(folded) - SIZE + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gram = np.zeros(count, dtype=np.uint64)
    for k in range(SIZE):
        gram |= folded[k : k + count] << np.uint64(8 * k)
    here = row[:count] == row[SIZE - 1 :]
    return gram[here], row[:count][here]


def slots(gram: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield (mix(gram, k) & np.uint64(SLOTS - 1)).astype(np.int64)


def _words_of(languages: int) -> int:
    return max(1, -(-languages // 64))


class Filter:
    """Languages (sorted), their rows in training, and the sliced Bloom filter."""

    def __init__(self, languages: list[str], common: str | None, held: list[tuple[int, int]]):
        """held: pairs of an n-gram and a language's index."""
        self.languages, self.common = languages, common
        self.masks = np.zeros((_words_of(len(languages)), SLOTS), dtype=np.uint64)
        pairs = np.array(held, dtype=np.int64).reshape(-1, 2)
        self.false = np.zeros(len(languages))
        for i in range(len(languages)):
            word, bit = self.masks[i // 64], np.uint64(1) << np.uint64(i % 64)
            for at in slots(pairs[pairs[:, 1] == i, 0].astype(np.uint64)):
                word[at] |= bit
            self.false[i] = float(((word & bit) != 0).mean()) ** HASHES

    def estimates(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Estimated share of each row's n-grams that each language holds."""
        gram, row = ngrams(data, offsets)
        rows = len(offsets) - 1
        total = np.bincount(row, minlength=rows)
        out = np.zeros((rows, len(self.languages)))
        at = list(slots(gram))
        for w, masks in enumerate(self.masks):
            found = masks[at[0]]
            for a in at[1:]:
                found &= masks[a]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                hits = np.bincount(row, weights=((found >> np.uint64(i % 64)) & np.uint64(1)).astype(np.float64), minlength=rows)
                out[:, i] = (hits / np.maximum(total, 1) - self.false[i]) / (1 - self.false[i] if self.false[i] < 1 else 1)
        out[total == 0] = 0
        return np.clip(out, 0, 1)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        names, index = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        for first, end, data, offsets in chunks(batch):
            gram, row = ngrams(data, offsets)
            for i in np.unique(index[first:end]):
                found, count = np.unique(gram[index[first:end][row] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([names[i]] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(count.astype(np.int64))], schema=schema)


def learn(docs: DataFrame) -> Filter:
    """The filter of all rows of ``docs`` (text, lang), both known; counted by Spark, bounded on the driver."""
    known = docs.where("lang is not null and text is not null").select("text", F.col("lang").cast("string"))
    rows = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not rows:
        return Filter([], None, [])
    languages = sorted(rows)
    counted = known.mapInArrow(_count_ngrams, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    by_lang = counted.groupBy("gram").pivot("lang", languages).agg(F.sum("n")) if len(languages) <= 64 else None
    held: list[tuple[int, int]] = []
    if by_lang is not None:
        table = materialize(by_lang.toDF("gram", *[f"l{i}" for i in range(len(languages))]), "ngram-counts")
        totals = table.agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(len(languages))]).first()
        share = [F.coalesce(F.col(f"l{i}"), F.lit(0)) / F.lit(float(totals[i] or 1)) for i in range(len(languages))]
        most = F.greatest(*share) if len(share) > 1 else share[0]
        for r in table.select("gram", *[((s >= LEAST_SHARE) & (s >= LEAST_RATIO * most)).alias(f"h{i}") for i, s in enumerate(share)]).where(most >= LEAST_SHARE).toLocalIterator():
            held += [(r[0], i) for i in range(len(languages)) if r[i + 1]]
    else:
        totals = {r[0]: r[1] for r in counted.groupBy("lang").agg(F.sum("n")).collect()}
        at = {name: i for i, name in enumerate(languages)}
        share = F.col("n") / F.create_map(*[F.lit(x) for kv in totals.items() for x in (kv[0], float(kv[1]))])[F.col("lang")]
        shares = counted.withColumn("share", share)
        most = shares.groupBy("gram").agg(F.max("share").alias("most"))
        kept = shares.join(most, "gram").where((F.col("share") >= LEAST_SHARE) & (F.col("share") >= LEAST_RATIO * F.col("most")))
        held = [(r[0], at[r[1]]) for r in kept.select("gram", "lang").toLocalIterator()]
    return Filter(languages, min(languages, key=lambda name: (-rows[name], name)), held)


def identify(docs: DataFrame, model: Filter, pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """All columns of ``docs`` plus ``pred`` and ``score``; columns of these names are replaced."""
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)
    taken = [c for c in docs.columns if c not in (pred, score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Filter = shared.value
        for batch in batches:
            names, scores = [], []
            for first, end, data, offsets in chunks(batch):
                share = known.estimates(data, offsets) if known.languages else np.zeros((end - first, 1))
                best = share.argmax(axis=1)
                for k in range(first, end):
                    value = float(share[k - first, best[k - first]])
                    text = batch.column("text")[k].as_py()
                    if not known.languages or text is None or not _LETTER.search(text):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                    else:
                        names.append(known.languages[best[k - first]] if value > 0 else known.common)
                        scores.append(value)
            arrays = [batch.column(c) for c in taken] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*taken, pred, score])

    schema = docs.select(*taken).withColumn(pred, F.lit("")).withColumn(score, F.lit(0.0)).schema
    return docs.select(*taken).mapInArrow(run, schema)


def language_report(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the documents that are not held out."""
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


#: Texts of so many code points, of which no language holds this share of the n-grams, are in no known language.
REJECT_BELOW, EVIDENCE = 0.2, 40


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents (all columns) in a language that the corpus teaches; ``und`` and texts foreign to all languages go.

    Texts too short to tell stay.
    """
    free = "_" * (1 + max((len(c) for c in docs.columns), default=0))
    pred, score = f"{free}pred", f"{free}score"
    found = identify(docs, learn(docs.where(~held_out())), pred, score)
    foreign = (F.col(score) < REJECT_BELOW) & (F.length("text") >= EVIDENCE)
    return found.where((F.col(pred) != UNKNOWN) & ~foreign).select(*docs.columns)
