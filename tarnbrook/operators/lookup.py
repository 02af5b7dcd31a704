"""Left key lookups that stay balanced when single keys dominate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of the rows on, so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.01
SALTS = 64
_TRACKED = 10_000
_BUCKETS = 4096


@dataclass(frozen=True)
class HotKeys:
    """Keys of one column (as text) that hold a large share of the rows."""

    values: tuple[str, ...] = ()
    null: bool = False

    def __bool__(self) -> bool:
        return self.null or bool(self.values)

    def holds(self, key: Column) -> Column:
        hot = F.coalesce(key.cast("string").isin(*self.values), F.lit(False)) if self.values else F.lit(False)
        return hot | key.isNull() if self.null else hot


def find_hot_keys(rows: DataFrame, keys: list[str], share: float = HOT_SHARE) -> dict[str, HotKeys]:
    """The hot keys of each column, from one pass over ``rows``.

    Each column has a bounded frequent-items sketch that is merged map-side: no
    key is shuffled, and at most ``1 / share`` values per column come back. The
    sketch is approximate, which can only change how rows are spread.
    """
    most = int(1 / share)
    found = rows.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.expr(f"approx_top_k(cast(`{k}` as string), {most}, {_TRACKED})").alias(f"top_{k}") for k in keys],
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
    ).first()
    limit = found["total"] * share
    return {
        k: HotKeys(
            tuple(t["item"] for t in found[f"top_{k}"] or [] if t["item"] is not None and t["count"] > limit),
            found[f"null_{k}"] > limit,
        )
        for k in keys
    }


def hot_keys_of_written(rows: DataFrame, keys: list[str], share: float = HOT_SHARE, buckets: int = _BUCKETS) -> dict[str, HotKeys]:
    """``find_hot_keys`` of rows that are cheap to read twice.

    Rows are first counted by a hash of each key, a cheaper pass than the sketches.
    A hot key makes its bucket hold more than ``share`` of the rows; without such a
    bucket a column has no hot key, and only the other columns are sketched.
    """
    counts = {k: rows.groupBy(F.pmod(F.xxhash64(k), F.lit(buckets)).alias("_bucket")).count() for k in keys}
    found = {k: c.agg(F.sum("count").alias("total"), F.max("count").alias("most")).first() for k, c in counts.items()}
    heavy = [k for k in keys if (found[k]["most"] or 0) > (found[k]["total"] or 0) * share]
    return {k: HotKeys() for k in keys} | (find_hot_keys(rows, heavy, share) if heavy else {})


def lookup(
    rows: DataFrame, dim: DataFrame, key: str, hot: HotKeys, spread_by: list[str], salts: int = SALTS
) -> DataFrame:
    """LEFT JOIN of ``rows`` to ``dim`` (unique on ``key``), hot keys spread over ``salts`` parts.

    Rows of a hot key get a salt from ``spread_by``, and only the dimension rows
    of hot keys are repeated, at most ``salts / HOT_SHARE`` rows. Without hot
    keys this is the plain join, whose strategy Catalyst picks by size.
    """
    if not hot:
        return rows.join(dim, key, "left")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    left = rows.withColumn("_salt", F.when(hot.holds(F.col(key)), salt).otherwise(0))
    repeats = F.when(hot.holds(F.col(key)), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.withColumn("_salt", F.explode(repeats))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
