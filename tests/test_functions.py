from datetime import date

from pyspark.sql import functions as F

from tarnbrook.functions.dates import date_parts, hours_before
from tarnbrook.functions.keys import fact_id, flight_id, row_id
from tarnbrook.functions.text import null_tokens, to_day, to_whole


def test_null_tokens(spark, rows):
    df = spark.createDataFrame([("NULL", "x"), ("", "NULL"), (None, ""), ("null", "Null")], "a string, b string")
    assert rows(null_tokens(df, ["a", "b"])) == sorted(
        [(None, "x"), (None, None), (None, None), ("null", "Null")], key=str
    )


def test_whole_numbers_round_and_reject(spark):
    cells = ["12", "12.6", "-3", "x", "12345678901", None, " 7 "]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(to_whole(F.col("c"), 10, "long")).collect()]
    assert got == [12, 13, -3, None, None, None, 7]
    assert df.select(to_whole(F.col("c"), 4, "int")).dtypes[0][1] == "int"


def test_days(spark):
    cells = ["6/28/2022", "12/26/2022", "31/31/2022", "2022-06-28", None, "06/05/2022"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(to_day(F.col("c"))).collect()]
    assert got == [date(2022, 6, 28), date(2022, 12, 26), None, None, None, date(2022, 6, 5)]


# Pilot, status, day, airport, expected hash, day of week, quarter.
FLIGHTS = [
    ("Edithe Leggis", "On Time", date(2022, 6, 28), "CXF", "45fa7bd5732f9db0f69c89453702a05b", 2, 2),
    ("Elwood Catt", "On Time", date(2022, 12, 26), "YCO", "e2852288b08f4f4c0b3083473886fd34", 1, 4),
    ("Dominica Pyle", "Delayed", date(2022, 9, 16), "YND", "e6ae417676f4ad9a70cbc621e10b9df2", 5, 3),
]


def test_flight_keys_and_date_parts(spark):
    df = spark.createDataFrame([f[:4] for f in FLIGHTS], "pilot string, status string, day date, airport string")
    parts = date_parts("day")
    got = df.selectExpr(
        flight_id("pilot", "status", "day", "airport"), parts["day_of_week"], parts["quarter"]
    ).collect()
    assert [tuple(r) for r in got] == [f[4:] for f in FLIGHTS]
    respelled = df.selectExpr(flight_id("concat(' ', upper(pilot), '  ')", "status", "day", "airport")).collect()
    assert [r[0] for r in respelled] == [f[4] for f in FLIGHTS]
    missing = df.selectExpr(flight_id("cast(null as string)", "status", "day", "airport")).collect()
    assert {r[0] for r in missing} == {None}


def test_fact_key(spark):
    one = spark.range(1).selectExpr(
        fact_id("'ABVWIg'", "cast(1 as long)", "date'2022-06-28'"),
        fact_id("'ABVWIg'", "cast(null as long)", "date'2022-06-28'"),
    ).first()
    assert one[0] == "d71ddbcc30db256c2cf7183d697ccced"
    assert one[1] is None


def test_row_ids_tell_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", "null"), ("a", ""), ("a", None)], "x string, y string")
    ids = [r[0] for r in df.selectExpr(row_id(["x", "y"])).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3]


def test_hour_arithmetic(spark):
    got = spark.range(1).selectExpr(f"cast({hours_before("timestamp'2024-01-01 00:30:00'", 1)} as string)").first()[0]
    assert got == "2023-12-31 23:30:00"
