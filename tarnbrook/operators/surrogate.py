"""Integer surrogate keys without a single-task global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnbrook.session import materialize

# monotonically_increasing_id() puts the partition number above these bits.
_ROW_BITS = 33


def assign_surrogate_keys(
    rows: DataFrame, natural_key: list[str], name: str, start: int = 0, only: Column | None = None
) -> DataFrame:
    """Number ``rows`` start+1, start+2, … in ``natural_key`` order (a total order).

    With ``only``, rows it is false for keep the value they have in ``name``;
    they sort behind the others and so do not disturb the numbering.

    The rows are range-partitioned and sorted once, then written with their
    position, so later reads cannot see other range bounds. A row's key is its
    position in its partition plus the rows in all partitions before: the table
    of those offsets has one row per partition, which bounds the broadcast and
    the unpartitioned window below.
    """
    kept = F.lit(False) if only is None else ~F.coalesce(only, F.lit(False))
    order = ["_kept", *natural_key]
    placed = materialize(
        rows.withColumn("_kept", kept)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        f"keys-{name}",
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", before.alias("_before"))
    in_partition = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = F.lit(start) + F.col("_before") + in_partition + 1
    if only is not None:
        number = F.when(F.col("_kept"), F.col(name)).otherwise(number)
    others = [c for c in rows.columns if c != name]
    return placed.join(F.broadcast(offsets), "_part").select(number.cast("long").alias(name), *others)
