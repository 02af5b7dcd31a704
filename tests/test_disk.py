"""What stays on disk: shuffle files, scratch copies, inbox files."""

import os
import time

from pyspark.sql import functions as F

from tarnbrook.operators.quality import Rule, split_quarantine
from tarnbrook.plans import star
from tarnbrook.session import REMOVE_SHUFFLE_FILES, materialize, path_exists, scratch_root, scratch_scope, side_by_side, writing
from tarnbrook.sources.csv_files import list_files, read_csv, write_lines


def has_setting(spark):
    return spark._jsparkSession.conf().getAll().contains(REMOVE_SHUFFLE_FILES)


def shuffle_files(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {local.apply(n).getName() for n in range(local.size()) if local.apply(n).getName().startswith("shuffle_")}


def test_writes_take_their_shuffle_files_with_them(spark):
    before = shuffle_files(spark)
    counted = spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).count()
    written = materialize(counted, "counted")
    until = time.time() + 20  # executors remove them a little later
    while left := {name for name in shuffle_files(spark) - before if name.endswith(".data")}:
        assert time.time() < until, left
        time.sleep(0.2)
    assert written.count() == 7 and not has_setting(spark)


def test_the_setting_holds_until_the_last_write_ends(spark):
    seen = []

    def write(n):
        with writing(spark):
            spark.range(n).count()
            seen.append(spark.conf.get(REMOVE_SHUFFLE_FILES))

    side_by_side(spark, [lambda n=n: write(n) for n in (1, 10, 100)])
    assert seen == ["true"] * 3 and not has_setting(spark)
    spark.conf.set(REMOVE_SHUFFLE_FILES, "false")
    try:
        write(1)
        assert seen[-1] == "false" and has_setting(spark)
    finally:
        spark.conf.unset(REMOVE_SHUFFLE_FILES)


def test_the_result_of_a_scope_stays_in_the_scope_around_it(spark):
    with scratch_scope(spark):
        with scratch_scope(spark, keep_last=True):
            step = materialize(spark.range(3), "step").inputFiles()[0]
            kept = materialize(spark.range(5), "result")
        assert kept.count() == 5 and not path_exists(spark, step)
        path = kept.inputFiles()[0]
        assert path.endswith(".zstd.parquet")
    assert not path_exists(spark, path)


def test_a_dimension_leaves_its_numbered_rows_only(spark):
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    rows = spark.createDataFrame([(f"p{n % 4}", f"2024-01-0{n % 3 + 1}", n) for n in range(12)], "passenger_id string, day string, n int")
    core = rows.selectExpr(
        "passenger_id", "'a' as first_name", "'b' as last_name", "'f' as gender", "n as age", "'x' as nationality", "to_date(day) as departure_date", "n as _n"
    )
    dim = star._star_dimension(core, star.PASSENGER_PLAN, ["_n desc"])
    assert dim.count() == 4
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before}
    assert left == {"keys-passenger_sk"}


def test_compressed_files_are_listed_and_read(spark, rows, tmp_path):
    folder = str(tmp_path / "inbox")
    df = spark.createDataFrame([("1", "a"), ("2", "NULL"), ("3", "c")], "k string, v string")
    write_lines(df, F.concat_ws(",", "k", "v"), ",V", folder, compression="gzip")
    found = list_files(spark, folder).collect()
    assert found and all(f["file_name"].endswith(".csv.gz") for f in found)
    assert rows(read_csv(spark, [f["file_path"] for f in found], df.schema), "k", "v") == [("1", "a"), ("2", None), ("3", "c")]


def test_good_rows_do_not_reach_the_array_of_violations(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, None)], "n int, v string")
    rules = [Rule("n:positive", "n > 0"), Rule("v:not_null", "v is not null")]
    _, bad = split_quarantine(df, rules)
    assert rows(bad.select("n", "v", F.array_join("_violations", ",").alias("x"))) == sorted(
        [(None, "b", "n:positive"), (3, None, "v:not_null"), (None, None, "n:positive,v:not_null")], key=str
    )
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter NOT coalesce" in plan
