"""Change capture on DataFrames: net changes, change pairs, as-of states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnbrook.functions.keys import row_id
from tarnbrook.operators.dedupe import latest_per_key


def net_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that differ between two states of a table, unique on ``keys``.

    Returns the keys, ``change`` (INSERT, UPDATE or DELETE) and both row images
    as the structs ``old`` and ``new``.
    """
    rest = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*rest).alias("old"))
    new = after.select(*keys, F.struct(*rest).alias("new"))
    return classify(old.join(new, keys, "full_outer"))


def net_changes_between(log: DataFrame, keys: list[str], order: list[str], first: Column, second: Column,
                        is_delete: Column) -> DataFrame:
    """Net changes between the states of an upsert log at two moments, in one pass.

    ``order`` begins with the column the moments are about and is total per key. Both states are the latest row per key up to ``first`` and up to ``second``;
    taking them as two conditional aggregates of one grouping replaces two
    windows and a full outer join, and combines map-side.
    """
    rest = [c for c in log.columns if c not in keys]
    row = F.struct(F.struct(*rest).alias("row"), is_delete.alias("gone"))
    moment, place = F.col(order[0]), F.struct(*order)
    states = (
        log.where(moment <= second)
        .groupBy(*keys)
        .agg(
            F.max_by(F.when(moment <= first, row), F.when(moment <= first, place)).alias("a"),
            F.max_by(row, place).alias("b"),
        )
    )

    def alive(side: str) -> Column:
        return F.when(~F.col(f"{side}.gone"), F.col(f"{side}.row"))

    return classify(states.select(*keys, alive("a").alias("old"), alive("b").alias("new")))


def classify(images: DataFrame) -> DataFrame:
    change = (
        F.when(F.col("old").isNull() & F.col("new").isNotNull(), "INSERT")
        .when(F.col("new").isNull() & F.col("old").isNotNull(), "DELETE")
        .when(~F.col("old").eqNullSafe(F.col("new")), "UPDATE")
    )
    return images.withColumn("change", change).where(F.col("change").isNotNull())


def change_pairs(net: DataFrame, keys: list[str]) -> DataFrame:
    """Net changes as change rows; an update becomes a DELETE and an INSERT row."""

    def image(side: str, action: str, is_update: bool) -> Column:
        return F.struct(F.col(side).alias("row"), F.lit(action).alias("_action"), F.lit(is_update).alias("_is_update"))

    images = (
        F.when(F.col("change") == "INSERT", F.array(image("new", "INSERT", False)))
        .when(F.col("change") == "DELETE", F.array(image("old", "DELETE", False)))
        .otherwise(F.array(image("old", "DELETE", True), image("new", "INSERT", True)))
    )
    return (
        net.select(*keys, F.inline(images))
        .select(*keys, "row.*", "_action", "_is_update")
        .withColumn("_row_id", F.expr(row_id(keys)))
    )


def collapse(log: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Net change pairs over an interval of a change log (``_version``, old and new images).

    Per key the image before the interval is its first row if that is a DELETE,
    and the image after it is its last row if that is an INSERT. Work grows
    with the changes in the interval and not with the table.
    """
    rest = [c for c in columns if c not in keys]
    place = F.struct(F.col("_version"), (F.col("_action") == "INSERT").cast("int").alias("half"))
    row = F.struct(F.struct(*rest).alias("row"), F.col("_action").alias("act"))
    ends = log.groupBy(*keys).agg(F.min_by(row, place).alias("a"), F.max_by(row, place).alias("b"))
    images = ends.select(
        *keys,
        F.when(F.col("a.act") == "DELETE", F.col("a.row")).alias("old"),
        F.when(F.col("b.act") == "INSERT", F.col("b.row")).alias("new"),
    )
    return change_pairs(classify(images), keys)


def has_changes(changes: DataFrame) -> DataFrame:
    """One row: is there any change? Reads until the first row only."""
    return changes.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_data"))


def as_of(log: DataFrame, keys: list[str], order: list[str], upto: Column, is_delete: Column) -> DataFrame:
    """State of an upsert log: the latest row per key where ``upto`` holds, without deleted keys."""
    return latest_per_key(log.where(upto), keys, order).where(~is_delete)
