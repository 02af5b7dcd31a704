"""Passenger rows out of order data: the driver tables in the shape of the core table.

customer -> passenger, supplier and its nation -> airport and pilot, line item -> flight leg.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnbrook.functions.text import DAY_FORMAT
from tarnbrook.operators.surrogate import assign_surrogate_keys
from tarnbrook.schemas import RAW_COLUMNS
from tarnbrook.session import materialize

# The line-item columns that make a row unique; they order rows of one day.
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax"]
# Pilots are spelled in two ways; the flight key must not care.
_SPELLED = "if(l_linestatus = 'F', concat('  ', upper(s_name), ' '), s_name)"

# Of an order, as all its lines have it.
_PASSENGER_ID = "lpad(conv(cast(o_custkey as string), 10, 36), 6, '0') as passenger_id"

COLUMNS = {
    "passenger_id": "passenger_id",
    "first_name": "c_name",
    "last_name": "o_orderpriority",
    "gender": "o_orderstatus",
    "age": "l_linenumber",
    "nationality": "c_nation",
    "airport_name": "s_name",
    "airport_country_code": "concat('C', lpad(cast(s_nationkey as string), 2, '0'))",
    "country_name": "n_name",
    "airport_continent": "substr(r_name, 1, 3)",
    "continents": "r_name",
    "departure_date": "departure_date",
    "arrival_airport": "concat('A', lpad(cast(s_nationkey as string), 2, '0'))",
    "pilot_name": _SPELLED,
    "flight_status": "l_returnflag",
    "ticket_type": "l_linestatus",
    "passenger_status": "o_orderstatus",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# What ``as_passengers`` needs of the joined tables: fewer columns than it makes, and fewer texts.
_JOINED = ["passenger_id", "c_name", "c_nation", "o_orderstatus", "o_orderpriority", "s_name", "s_nationkey", "n_name", "r_name",
           "to_date(l_shipdate) as departure_date", "l_returnflag", "l_linestatus", *LINE_COLUMNS]


def passenger_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Core columns (without index_col) and the line-item columns as ``_l_…``."""
    return as_passengers(joined_lines(spark, folder))


def as_passengers(lines: DataFrame) -> DataFrame:
    """``passenger_rows`` of ``joined_lines``, row by row: where lines are written, a reader derives the columns it takes."""
    return lines.selectExpr(*[f"{e} as {c}" for c, e in COLUMNS.items()], *[f"{c} as _{c}" for c in LINE_COLUMNS])


def joined_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order, customer, supplier, nations and region, a row each.

    Orders take their customer before they meet the line items, so the largest
    table is shuffled once, on the order key. Supplier, nation and region follow
    one by one: each is judged by its own file size and broadcast if small,
    which a join of joins, whose size Catalyst can only multiply, would not be.
    """
    nation = read_table(spark, folder, "nation")
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"))
    orders = read_table(spark, folder, "orders").join(
        read_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(home, "c_nationkey")
    orders = orders.selectExpr("o_orderkey", _PASSENGER_ID, "o_orderstatus", "o_orderpriority", "c_name", "c_nation")
    suppliers = read_table(spark, folder, "supplier")
    return (
        read_table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(*_JOINED)
    )


def tie_break() -> list[str]:
    """Total order of rows with one departure date: all line-item columns decide."""
    return [f"_{c} desc" for c in LINE_COLUMNS]


def line_order() -> list[str]:
    return ["_" + c for c in LINE_COLUMNS] + ["departure_date", "flight_status", "ticket_type"]


# An order of more rows than this is not numbered by one task.
MOST_ROWS = 100_000


def numbered_rows(spark: SparkSession, folder: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """``passenger_rows`` with ``index_col``: 1, 2, … in ``line_order``; to be written before it is used twice.

    The rows of an order follow each other. So orders are counted and take their
    first numbers, a narrow table, and the rows are numbered within their order where
    the join on the order key has put them: the wide rows move once. An order of more
    than ``most_rows`` would fill one task; then all rows are numbered by ranges.
    """
    rows, key = passenger_rows(spark, folder), line_order()[0]
    sizes = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "order-sizes")
    if (sizes.agg(F.max("_n")).first()[0] or 0) > most_rows:
        return assign_surrogate_keys(rows, line_order(), "index_col")
    ranged = sizes.repartitionByRange(key).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "order-ranges")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    parts = parts.select("_part", F.coalesce(F.sum("_sum").over(earlier.orderBy("_part")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("_n").over(earlier.partitionBy("_part").orderBy(key)), F.lit(0))
    first = ranged.withColumn("_inside", inside).join(F.broadcast(parts), "_part").select(key, (F.col("_before") + F.col("_inside")).alias("_first"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(*line_order()[1:]))
    return rows.join(materialize(first, "order-starts"), key).withColumn("index_col", F.col("_first") + place).drop("_first")


def csv_line() -> Column:
    """One CSV line of a row that has ``index_col``."""
    cells = [
        F.date_format(c, DAY_FORMAT) if c == "departure_date" else F.col(c).cast("string") for c in RAW_COLUMNS
    ]
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])
