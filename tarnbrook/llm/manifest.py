"""A Merkle manifest of a dataset: hash trees per group and over the groups, proofs without joins.

Every row is a leaf. Within a group (``source``) leaves ascend by ``doc_id``, and while
several nodes remain every ``FAN`` consecutive ones become their hash; the groups'
roots, in order of the group, go up to the dataset's root likewise.

A leaf's rank in its group is a number in base ``FAN``. The tree is a rollup over its
digits: rows are dealt to blocks of ``FAN ** DIGITS`` ranks, and inside a block the last
digit is grouped away, then the next, each grouping nesting the structs of the one
before, all after one exchange. A block is thus one row of bounded size. Block nodes
are ranked by construction and are folded again until every group has one node, so a
group that holds a third of all rows is many blocks and never one task.

Proofs come back down the same nesting: a block row meets the path of its own node
(which the level above has emitted) by one grouping of their union, and each nested
array is exploded with the hashes of its siblings. No table is joined with another
except for the ranks' offsets, a broadcast of one row per sorted partition.

Null doc_id and null source are values like others and come first. Rows that share
a doc_id are ordered by their leaf hash; rows equal in all fields are leaves of
their own. Null and empty texts are told apart (``-`` and ``0:``). An empty table
gives an empty result. Texts are hashed whole, in the first stage, and never moved.
Only the five fields are read, so other columns can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnbrook.session import materialize

FAN = 16
#: Digits of the rank that one block nests.
DIGITS = 2

#: Every so many documents (by a checksum of the id) are altered in the query.
ALTERED_OF = 5

_ROW_BITS = 33
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spelled(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**fields: Column) -> Column:
    """Hash of a row: each field ``-`` if null, else its length in bytes, ``:`` and its value."""
    return F.sha2(F.concat(*[_spelled(fields[f]) for f in _FIELDS]), 256)


def leaf_rows(docs: DataFrame, altered_text: Column | None = None) -> DataFrame:
    """(grp, id, h, claim): the leaf of each row, and the leaf that a holder of ``altered_text`` would claim."""
    fields = {f: F.col(f) for f in _FIELDS}
    leaf = leaf_hash(**fields)
    claim = leaf if altered_text is None else F.when(
        altered_text.isNotNull() & (altered_text != F.col("text")), leaf_hash(**fields | {"text": altered_text})
    )
    return docs.select(F.col("source").alias("grp"), F.col("doc_id").alias("id"), leaf.alias("h"), claim.alias("claim")).withColumn(
        "claim", F.coalesce("claim", "h")
    )


def ranked(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` (grp, id, h, …) with ``r``, the rank in the group by (id, h), from 0.

    The rows are range-partitioned and sorted once and written with their place. Only
    the first group of a partition can have rows in earlier ones, so the offsets
    that are broadcast have one row per partition.
    """
    order = ["grp", "id", "h"]
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), label
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = (
        placed.groupBy("_part", "grp").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_before", before)
        .where(F.col("_first").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) == 0)
        .select(F.col("_part").alias("_p"), F.col("grp").alias("_g"), "_before")
    )
    within = F.row_number().over(Window.partitionBy("_part", "grp").orderBy("_at")).cast("long") - 1
    numbered = placed.withColumn("_in", within).join(
        F.broadcast(offsets), (F.col("_part") == F.col("_p")) & F.col("grp").eqNullSafe(F.col("_g")), "left"
    )
    return numbered.select(*rows.columns, (F.col("_in") + F.coalesce("_before", F.lit(0))).alias("r"))


def _joined_hash(kids: str) -> Column:
    return F.sha2(F.array_join(F.col(f"{kids}.h"), ""), 256)


def fold(nodes: DataFrame) -> DataFrame:
    """Blocks (grp, r, h, depth, kids) of ``nodes`` (grp, r, h, item).

    ``kids`` nests ``DIGITS`` levels of runs; ``depth`` is how many of them the group's
    tree has here: all, except in the only block of a group that needs fewer.
    """
    digit = lambda k: F.pmod(F.floor(F.col("r") / F.lit(FAN**k)), F.lit(FAN)).cast("int")
    rows = nodes.select(
        "grp", F.expr(f"r div {FAN ** DIGITS}").alias("b"), *[digit(k).alias(f"d{k}") for k in range(DIGITS)], "h", F.col("item").alias("kids")
    ).repartition("grp", "b")
    for k in range(DIGITS):
        kid = F.struct(F.col(f"d{k}").alias("d"), "h", "kids")
        above = [f"d{j}" for j in range(k + 1, DIGITS)]
        rows = rows.groupBy("grp", "b", *above).agg(F.sort_array(F.collect_list(kid)).alias("kids")).withColumn("h", _joined_hash("kids"))
    # Levels whose run has one node count only where a higher level needs them.
    single = ["kids" + "[0].kids" * k for k in range(DIGITS)]
    depth = F.when(F.col("b") > 0, DIGITS)
    for k, kids in enumerate(single):
        depth = depth.when(F.size(F.expr(kids)) > 1, DIGITS - k)
    rows = rows.withColumn("depth", depth.otherwise(0))
    node = reduce(lambda found, k: found.when(F.col("depth") == DIGITS - k, F.expr(single[k - 1] + "[0].h")), range(1, DIGITS + 1), F.when(F.col("depth") == DIGITS, F.col("h")))
    return rows.select("grp", F.col("b").alias("r"), node.alias("h"), "depth", "kids")


def unfold(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, r, item, h, path, subroot, root) of every node folded into ``blocks``.

    ``above`` (grp, r, path, subroot, root) has the path of each block's own node. A path
    lists, from the node up, its position in its run and the run's other hashes.
    """
    carried = ["path", "subroot", "root"]
    both = blocks.select("grp", "r", "depth", "kids", *[F.lit(None).cast(above.schema[c].dataType).alias(c) for c in carried]).unionByName(
        above.select("grp", "r", F.lit(None).cast("int").alias("depth"), F.lit(None).cast(blocks.schema["kids"].dataType).alias("kids"), *carried)
    )
    rows = both.repartition("grp", "r").groupBy("grp", "r").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("depth", "kids", *carried)])
    for level in range(DIGITS, 0, -1):
        rows = rows.select("grp", "r", "depth", *carried, F.col("kids.h").alias("run"), F.posexplode("kids").alias("place", "kid"))
        step = F.struct(F.col("place").alias("position"), F.expr("filter(run, (x, i) -> i <> place)").alias("siblings"))
        rows = rows.select(
            "grp", (F.col("r") * FAN + F.col("place")).alias("r"), "depth",
            F.when(F.col("depth") >= level, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path")).alias("path"),
            "subroot", "root", F.col("kid.h").alias("h"), F.col("kid.kids").alias("kids"),
        )
    return rows.select("grp", "r", F.col("kids").alias("item"), "h", *carried)


_NO_PATH = "cast(array() as array<struct<position: int, siblings: array<string>>>)"


def _tree(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of each level, the last with one block per group."""
    levels = []
    while True:
        blocks = materialize(fold(nodes), label)
        levels.append(blocks)
        if blocks.where("r > 0").isEmpty():
            return levels
        nodes = blocks.select("grp", "r", "h", F.lit(None).cast("string").alias("item"))


def _proved(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    for blocks in reversed(levels):
        found = unfold(blocks, above)
        above = found.select("grp", "r", "path", "subroot", "root")
    return found


def manifest(docs: DataFrame, altered_text: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, claim, path, subroot, root) of every row of ``docs``.

    ``path`` proves the leaf: with the position in its run and the run's other hashes,
    level by level up to ``root``, anybody can recompute the root (``folded``).
    ``claim`` is the leaf of the row with ``altered_text`` in place of its text.
    """
    leaves = materialize(leaf_rows(docs, altered_text), "manifest-leaves")
    nodes = ranked(leaves, "manifest-ranks").select("grp", "r", "h", F.struct("id", "claim").alias("item"))
    levels = _tree(nodes, "manifest-blocks")
    subroots = levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("id"), "h")
    tops = _tree(ranked(subroots, "manifest-groups").select("grp", "r", "h", F.struct("id").alias("item")), "manifest-top")
    root = tops[-1].select("grp", "r", F.expr(_NO_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    groups = _proved(tops, root).select(F.col("item.id").alias("grp"), F.lit(0).cast("long").alias("r"), "path", F.col("h").alias("subroot"), "root")
    proved = _proved(levels, groups)
    return proved.select(F.col("item.id").alias("doc_id"), F.col("grp").alias("source"), F.col("h").alias("leaf"), F.col("item.claim").alias("claim"), "path", "subroot", "root")


def folded(leaf: str, path: str) -> Column:
    """The root that a leaf and its path lead to."""
    return F.expr(
        f"aggregate({path}, {leaf}, (h, p) -> sha2(concat(array_join(slice(p.siblings, 1, p.position), ''), h,"
        " array_join(slice(p.siblings, p.position + 1, size(p.siblings) - p.position), '')), 256))"
    )


def manifest_report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``manifest`` with the texts of a fifth of the documents lower-cased for the check."""
    lowered = F.translate("text", _UPPER, _LOWER)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % ALTERED_OF == 0
    rows = manifest(docs, F.when(chosen, lowered))
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.flatten(F.col("path.siblings")), ""), 256).alias("proof_sha256"),
        folded("claim", "path").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
