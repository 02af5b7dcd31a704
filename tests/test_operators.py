import pytest
from pyspark.sql import functions as F

from tarnbrook.operators.changes import (
    as_of, change_pairs, collapse, has_changes, net_changes, net_changes_between,
)
from tarnbrook.operators.dedupe import latest_per_key
from tarnbrook.operators.lookup import HotKeys, find_hot_keys, hot_keys_of_written, lookup
from tarnbrook.operators.policy import CONTINENT_EUROPE, VIEW_COLUMNS, RowPolicy, flights_airports, flights_airports_secure
from tarnbrook.operators.quality import (
    Rule, assert_unique, key_report, not_null, orphans, reference_report, split_quarantine, tag_violations, width,
)
from tarnbrook.operators.surrogate import assign_surrogate_keys


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_rows_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), (None, 3, "m")], "k string, d int, v string")
    latest = latest_per_key(df, ["k"], ["d desc", "v desc"])
    assert rows(latest, "k", "v") == [("a", "y"), ("b", "z"), (None, "m")]
    assert "WindowGroupLimit" in plan_of(latest) and "Partial" in plan_of(latest)


def test_latest_per_key_breaks_ties_by_order(spark, rows):
    df = spark.createDataFrame([("a", 1, i) for i in range(50)], "k string, d int, i int").repartition(8)
    assert rows(latest_per_key(df, ["k"], ["d desc", "i desc"]), "i") == [(49,)]


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(5000).select(F.format_string("n%05d", F.pmod(F.col("id") * 7919, F.lit(5000))).alias("n")).repartition(8)
    got = assign_surrogate_keys(df, ["n"], "sk", start=100).orderBy("n").collect()
    assert [r["sk"] for r in got] == list(range(101, 5101))
    assert "sk" not in df.columns


def test_surrogate_keys_for_some_rows_only(spark, rows):
    df = spark.createDataFrame([("d", 7, False), ("b", None, True), ("a", 3, False), ("c", None, True)], "n string, sk long, new boolean")
    got = assign_surrogate_keys(df.repartition(4), ["n"], "sk", start=7, only=F.col("new"))
    assert rows(got, "n", "sk") == [("a", 3), ("b", 8), ("c", 9), ("d", 7)]


def test_surrogate_keys_of_nothing(spark):
    assert assign_surrogate_keys(spark.createDataFrame([], "n string"), ["n"], "sk").count() == 0


@pytest.fixture
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    return spark.range(3000).select(key.alias("k"), F.col("id").alias("row"))


def test_hot_keys_are_found(skewed):
    found = find_hot_keys(skewed, ["k", "row"])
    assert found["k"] == HotKeys(("hot",), True)
    assert not found["row"]


def test_hot_keys_are_found_in_full_buckets_only(spark, skewed, monkeypatch):
    assert hot_keys_of_written(skewed, ["k", "row"]) == find_hot_keys(skewed, ["k", "row"])
    monkeypatch.setattr("tarnbrook.operators.lookup.find_hot_keys", None)
    assert hot_keys_of_written(skewed, ["row"]) == {"row": HotKeys()}
    assert hot_keys_of_written(skewed.limit(0), ["k"]) == {"k": HotKeys()}


def test_spread_lookup_equals_the_plain_join(spark, skewed, rows):
    dim = skewed.select("k").distinct().where("k is null or k <> '5'").withColumn("sk", F.xxhash64("k"))
    plain = skewed.join(dim, "k", "left")
    spread = lookup(skewed, dim, "k", find_hot_keys(skewed, ["k"])["k"], ["row"], salts=4)
    assert sorted(spread.columns) == sorted(plain.columns)
    assert rows(spread, "k", "row", "sk") == rows(plain, "k", "row", "sk")
    assert spread.count() == 3000


def test_hot_keys_of_dates(spark, rows):
    df = spark.sql("select date'2024-01-01' as d, id from range(10) union all select date'2024-01-02', 10")
    dim = spark.sql("select date'2024-01-01' as d, 5 as sk")
    hot = find_hot_keys(df, ["d"], share=0.5)["d"]
    assert hot.values == ("2024-01-01",)
    assert rows(lookup(df, dim, "d", hot, ["id"]).groupBy("sk").count()) == [(5, 10), (None, 1)]


STATE = "k int, v string"


def states(spark):
    return (
        spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], STATE),
        spark.createDataFrame([(2, "b"), (3, "c"), (4, "D"), (5, None)], STATE),
    )


def test_net_changes_and_pairs(spark, rows):
    before, after = states(spark)
    net = net_changes(before, after, ["k"])
    assert rows(net, "k", "change") == [(1, "DELETE"), (3, "UPDATE"), (4, "UPDATE"), (5, "INSERT")]
    pairs = change_pairs(net, ["k"])
    assert rows(pairs, "k", "v", "_action", "_is_update") == sorted([
        (1, "a", "DELETE", False), (3, None, "DELETE", True), (3, "c", "INSERT", True),
        (4, "d", "DELETE", True), (4, "D", "INSERT", True), (5, None, "INSERT", False),
    ], key=str)
    removed = pairs.where("_action = 'DELETE'").select("k", "v")
    added = pairs.where("_action = 'INSERT'").select("k", "v")
    assert rows(before.exceptAll(removed).unionAll(added)) == rows(after)
    assert has_changes(net).first()[0] is True
    assert has_changes(net_changes(after, after, ["k"])).first()[0] is False


def test_log_in_one_pass_equals_two_states(spark, rows):
    log = spark.createDataFrame(
        [(k, t, "error" if (k * t) % 5 == 0 else f"v{(k + t) % 3}") for k in range(8) for t in range(1, 10) if (k + t) % 2],
        "k int, t int, v string",
    )
    gone = F.col("v") == "error"
    a, b = (as_of(log, ["k"], ["t desc"], F.col("t") <= at, gone) for at in (4, 8))
    slow = net_changes(a, b, ["k"])
    fast = net_changes_between(log, ["k"], ["t"], F.lit(4), F.lit(8), gone)
    assert rows(fast, "k", "change", "old.t", "new.t") == rows(slow, "k", "change", "old.t", "new.t")


def test_collapse_keeps_the_ends(spark, rows):
    log = spark.createDataFrame(
        [
            (1, "new", "INSERT", False, 1), (1, "new", "DELETE", True, 2), (1, "newer", "INSERT", True, 2),
            (2, "x", "DELETE", False, 1), (2, "y", "INSERT", False, 3),
            (3, "in", "INSERT", False, 1), (3, "in", "DELETE", False, 2),
            (4, "p", "DELETE", True, 1), (4, "q", "INSERT", True, 1), (4, "q", "DELETE", True, 2), (4, "p", "INSERT", True, 2),
            (5, "z", "DELETE", False, 2),
        ],
        "k int, v string, _action string, _is_update boolean, _version long",
    )
    got = rows(collapse(log, ["k"], ["k", "v"]), "k", "v", "_action", "_is_update")
    assert got == sorted([
        (1, "newer", "INSERT", False), (2, "x", "DELETE", True), (2, "y", "INSERT", True), (5, "z", "DELETE", False),
    ], key=str)


def test_rules_and_quarantine(spark, rows):
    df = spark.createDataFrame([(1, "ab"), (2, "abcd"), (3, None), (None, "abcd")], "k int, v string")
    rules = [not_null("k"), width("v", 3), Rule("k:positive", "k > 0")]
    good, bad = split_quarantine(df, rules)
    assert rows(good) == [(1, "ab"), (3, None)]
    assert rows(bad, "v", "_violations") == [
        ("abcd", ["k:not_null", "v:width", "k:positive"]), ("abcd", ["v:width"]),
    ]
    assert tag_violations(df, rules).count() == 4


def test_key_and_reference_reports(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, None), (3, "z"), (3, "z")], "k int, f string")
    parent = spark.createDataFrame([("a",), ("b",)], "p string")
    assert rows(key_report(df, "t", ["k"])) == [("t:unique(k)", 2, 5)]
    assert rows(reference_report(df, "t", "f", parent, "p")) == [("t:reference(f)", 1, 2)]
    assert rows(orphans(df, "f", parent, "p")) == [("z", 2)]
    assert rows(reference_report(df.where("f = 'a'"), "t", "f", parent, "p")) == [("t:reference(f)", 0, 0)]
    assert_unique(parent, "parent", ["p"])
    with pytest.raises(ValueError, match="several rows"):
        assert_unique(df, "t", ["k"])


def test_policy_applies_after_the_limit(spark, rows):
    airports = spark.createDataFrame(
        [(1, "A1", "n1", "c1", "Europe"), (2, "A2", "n2", "c2", "Asia"), (3, "A3", "n3", "c3", None)],
        "airport_sk long, airport_code string, airport_name string, country_name string, continent_name string",
    )
    fact = spark.createDataFrame(
        [(f"{n:03d}", n, n, n % 4, n) for n in range(200)],
        "id string, passenger_sk long, flight_sk long, airport_sk long, date_sk long",
    )
    view = flights_airports(fact, airports)
    assert view.columns == VIEW_COLUMNS and view.count() == 100
    secured = flights_airports_secure(fact, airports)
    joined = [n for n in range(200) if n % 4][:100]
    assert rows(secured, "id") == [(f"{n:03d}",) for n in joined if n % 4 == 1]
    hidden = RowPolicy("none", lambda c: F.lit(None).cast("boolean")).attach(view, "continent_name")
    assert hidden.count() == 0
    assert CONTINENT_EUROPE.name == "continent_europe_policy"
