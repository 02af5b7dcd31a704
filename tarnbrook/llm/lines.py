"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

A line's key is its text without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in
lower case. Keys are held as two 64-bit hashes. ``LineRuns`` takes documents in
batches: a batch is summed to one row per key (documents that hold it, largest
doc_id), merge-anti-joined with what the runs know, and what is news becomes a run
of its own, sorted by key: a key that already has enough documents and a larger
doc_id adds nothing. When a level has ``fanout`` runs they are merged to one run of
the next level, so a key lies in few files and old rows are rewritten rarely.

Documents are told apart by doc_id: rows that share one count as one document.
Rows without doc_id are neither counted nor changed. A null text is one empty line.
An empty table gives an empty result; other columns pass through unread.
Hot lines are summed before the shuffle; a join with them is split by AQE.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbrook.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
MIN_POINTS = 20
MIN_DOCS = 3
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() also changes letters beyond A-Z, so it serves pure ASCII lines only.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(doc_id, h1, h2), once per row of ``docs`` and key of ``min_points`` code points or more."""
    keys = F.transform(split_lines(F.col("text")), line_key)
    hashes = F.transform(F.filter(keys, lambda k: F.length(k) >= min_points), key_hash)
    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.explode(F.array_distinct(hashes)).alias("k")).select("doc_id", "k.h1", "k.h2")


class LineRuns:
    """Runs by level; each is a written table of (h1, h2, docs, last)."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = 3):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def known(self) -> DataFrame | None:
        """Documents and largest doc_id per key, over all runs."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return None
        return self._merged(runs) if len(runs) > 1 else runs[0]

    def add(self, batch: DataFrame) -> None:
        """Take a batch of ``line_hashes`` rows of documents that no earlier batch had."""
        summed = batch.distinct().groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        known = self.known()
        if known is not None:
            settled = known.where(F.col("docs") >= self.min_docs).select(*KEY, F.col("last").alias("known_last"))
            summed = summed.join(settled.hint("merge"), [summed[k] == settled[k] for k in KEY] + [settled["known_last"] >= summed["last"]], "left_anti")
        self._put(0, summed)

    def repeated(self) -> DataFrame:
        """(h1, h2, last) of the keys that enough documents hold."""
        known = self.known()
        if known is None:
            return self.spark.createDataFrame([], "h1 long, h2 long, last long")
        return known.where(F.col("docs") >= self.min_docs).select(*KEY, "last")

    def _put(self, level: int, rows: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(materialize(rows.sortWithinPartitions(*KEY), f"line-run-{level}"))
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


def drop_repeated_lines(docs: DataFrame, batches: int = 4, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns of ``docs`` plus ``_lines`` (as split), ``_kept`` (text without the dropped lines) and ``_dropped``."""
    spark = docs.sparkSession
    hashes = materialize(line_hashes(docs, min_points), "line-hashes")
    runs = LineRuns(spark, min_docs)
    for b in range(batches):
        runs.add(hashes.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b))
    repeated = runs.repeated()
    gone = (
        hashes.join(repeated, KEY)
        .where(F.col("doc_id") < F.col("last"))
        .groupBy(F.col("doc_id").alias("_gone_id"))
        .agg(F.collect_set(F.struct(*KEY)).alias("_gone"))
    )
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda line: (F.length(line) < min_points) | (F.length(line_key(line)) < min_points) | ~F.array_contains(F.col("_gone"), key_hash(line_key(line))))
    )
    return (
        docs.join(gone, docs["doc_id"] == gone["_gone_id"], "left")
        .withColumn("_lines", lines)
        .withColumn("_left", kept)
        .withColumn("_dropped", (F.size("_lines") - F.size("_left")).cast("long"))
        .withColumn("_kept", F.array_join("_left", "\n"))
        .drop("_gone", "_gone_id", "_left")
    )


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"),
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with the other lines only; ``n_chars``, where there is one, counts the new text.

    The caller's other columns travel as one struct, so that none can clash.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    numbered = {c: f"c{i}" for i, c in enumerate(others)}
    held = [F.col(f"`{c}`").alias(n) for c, n in numbered.items()] or [F.lit(0).alias("c0")]
    carried = docs.select("doc_id", "text", F.struct(*held).alias("others"))
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    changed = {"doc_id": F.col("doc_id"), "text": text}
    changed |= {"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return drop_repeated_lines(carried).select(*[(changed[c] if c in changed else F.col("others").getField(numbered[c])).alias(c) for c in docs.columns])
