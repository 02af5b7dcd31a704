"""Sharding by a histogram sort: equal bytes per shard, found without sorting.

Rows are ordered by a 120-bit key: 60 bits of a hash of the text, then 60 bits of a
hash of doc_id. Each round counts, over all rows, the exact bytes in every bin
below the open splitters (4,096 bins under each key prefix still in question) and
keeps the bin edge nearest to a splitter's target, or looks into the bin that
holds the target, until every edge is within the tolerance. Then the rows are
exchanged once. Equal texts follow each other in the key order, so a group of
copies stays in one shard unless it is itself larger than the tolerance allows;
then its rows are cut by the hash of doc_id.

Only counters of bins come to the driver (at most 4,096 per open splitter). Slots
count within buckets of a bounded expected size, offset by the buckets before.

Null doc_id and null text are values like others (a null text has no bytes). Rows
that agree in text and doc_id share a key and stay together. An empty table gives
an empty result. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnbrook.session import materialize

BIN_BITS = 12
WORD_BITS = 60
ROW_OVERHEAD = 16
SLOT_BUCKET_ROWS = 200_000


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - WORD_BITS).alias("k1"),
        F.shiftrightunsigned(F.xxhash64(F.lit("row"), F.col("doc_id")), 64 - WORD_BITS).alias("k2"),
    )


def _prefix(depth: int) -> tuple[Column, Column]:
    """The first ``depth`` bits of the key, as a pair."""
    high = F.shiftrightunsigned("k1", max(WORD_BITS - depth, 0))
    low = F.shiftrightunsigned("k2", 2 * WORD_BITS - depth) if depth > WORD_BITS else F.lit(0).cast("long")
    return high, low


def _edge(prefix: tuple[int, int], depth: int) -> tuple[int, int]:
    """The smallest key that has the given prefix."""
    if depth <= WORD_BITS:
        return prefix[0] << (WORD_BITS - depth), 0
    return prefix[0], prefix[1] << (2 * WORD_BITS - depth)


def splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """The ``shards - 1`` key boundaries; a row belongs above each boundary that is not larger than its key."""
    open_: dict[tuple[int, int], list[tuple[int, float]]] = {}
    found: dict[int, tuple[int, int]] = {}
    below: dict[tuple[int, int], int] = {(0, 0): 0}
    allowed, depth = 0.0, 0
    while not depth or open_:
        wider = depth + BIN_BITS
        here = keyed
        if depth:
            high, low = _prefix(depth)
            if depth <= WORD_BITS:
                here = keyed.where(high.isin([p[0] for p in open_]))
            else:
                here = keyed.where(F.struct(high.alias("a"), low.alias("b")).isin([F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in open_]))
        high, low = _prefix(wider)
        counted = sorted((r["a"], r["b"], r["bytes"]) for r in here.groupBy(high.alias("a"), low.alias("b")).agg(F.sum("size").alias("bytes")).collect())
        if not depth:
            total = sum(c[2] for c in counted)
            if not total:
                return []
            allowed = tolerance * total / shards
            open_ = {(0, 0): [(i, total * i / shards) for i in range(1, shards)]}
        bins: dict[tuple[int, int], list[tuple[tuple[int, int], int]]] = {}
        for a, b, size in counted:
            outer = (a >> BIN_BITS, 0) if wider <= WORD_BITS else (a, b >> BIN_BITS)
            bins.setdefault(outer, []).append(((a, b), size))
        following: dict[tuple[int, int], list[tuple[int, float]]] = {}
        starts: dict[tuple[int, int], int] = {}
        for outer, targets in open_.items():
            for index, target in targets:
                at = below[outer]
                for prefix, size in bins[outer]:
                    if at + size < target:
                        at += size
                        continue
                    if target - at <= allowed:
                        found[index] = _edge(prefix, wider)
                    elif at + size - target <= allowed:
                        found[index] = _edge((prefix[0], prefix[1] + 1) if wider > WORD_BITS else (prefix[0] + 1, 0), wider)
                    elif wider == 2 * WORD_BITS:  # rows with one key: the nearer side
                        found[index] = prefix if target - at <= at + size - target else (prefix[0], prefix[1] + 1)
                    else:
                        following.setdefault(prefix, []).append((index, target))
                        starts[prefix] = at
                    break
        # A prefix that fills the whole first word becomes the pair (first word, 0 bits of the second).
        open_, below, depth = following, starts, wider
    return [found[i] for i in sorted(found)]


def shard_by_bytes(docs: DataFrame, shards: int = 40, tolerance: float = 0.01) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard) of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 16. Each of the ``shards`` boundaries
    is within ``tolerance`` of a shard's share of the bytes, as far as rows with one
    key allow it.
    """
    keyed = materialize(_keyed(docs), "shard-keys")
    bounds = splitters(keyed, shards, tolerance)
    k1, k2 = F.col("k1"), F.col("k2")
    shard = F.lit(0)
    for a, b in bounds:
        above = (k1 >= F.lit(a)) if b == 0 else ((k1 > F.lit(a)) | ((k1 == F.lit(a)) & (k2 >= F.lit(b))))
        shard = shard + above.cast("int")
    buckets = max(1, -(-keyed.count() // (shards * SLOT_BUCKET_ROWS)))
    placed = keyed.withColumn("shard", shard).withColumn("bucket", F.pmod(F.xxhash64(F.lit("slot"), "k2"), F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "bucket").orderBy("k1", "k2", "doc_id")
    return (
        placed.withColumn("place", F.row_number().over(within))
        .join(bases, ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("base") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
