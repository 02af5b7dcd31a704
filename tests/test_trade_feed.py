"""Rows of the driver tables, numbered in the order of their lines."""

import pytest
from pyspark.sql import functions as F

from tarnbrook.operators.surrogate import assign_surrogate_keys
from tarnbrook.plans import star
from tarnbrook.plans.queries import star as whole_star
from tarnbrook.plans.trade_feed import line_order, numbered_rows, passenger_rows, tie_break
from tarnbrook.schemas import FACT


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders of 0 to 40 lines, some without customer or key; lines without an order, a supplier or a key, lines that come twice."""
    root = str(tmp_path_factory.mktemp("tables"))
    spark.sql("select cast(id as int) n_nationkey, concat('NATION ', id) n_name, cast(id % 2 as int) n_regionkey from range(3)").write.parquet(f"{root}/nation.parquet")
    spark.sql("select cast(id as int) r_regionkey, concat('REGION ', id) r_name from range(2)").write.parquet(f"{root}/region.parquet")
    spark.sql("select id c_custkey, concat('C', id) c_name, cast(id % 3 as int) c_nationkey from range(1, 20)").write.parquet(f"{root}/customer.parquet")
    spark.sql("select id s_suppkey, concat('S', id) s_name, cast(id % 3 as int) s_nationkey from range(1, 6)").write.parquet(f"{root}/supplier.parquet")
    orders = spark.sql("""select if(id = 7, null, id * 5) o_orderkey, 1 + id % 21 o_custkey, if(id % 2 = 0, 'F', 'O') o_orderstatus,
        concat(id % 5, '-LEVEL') o_orderpriority from range(60)""")
    orders.write.parquet(f"{root}/orders.parquet")
    lines = spark.sql("""select if(id % 53 = 0, null, (id * id % 61) * 5) l_orderkey, id * 7 % 11 l_partkey, if(id % 19 = 0, null, 1 + id % 6) l_suppkey,
        cast(id % 4 as int) l_linenumber, cast(id % 13 as double) l_quantity, if(id % 17 = 0, null, id * 1.5D) l_extendedprice, 0D l_discount, 0D l_tax,
        if(id % 3 = 0, 'R', 'N') l_returnflag, if(id % 2 = 0, 'F', 'O') l_linestatus, timestamp '1995-01-01' + make_interval(0, 0, 0, cast(id % 900 as int)) l_shipdate
        from range(1200)""")
    lines.unionByName(lines.where("l_linenumber = 2")).repartition(7).write.parquet(f"{root}/lineitem.parquet")
    return root


@pytest.mark.parametrize("most_rows", [100_000, 5])
def test_numbers_follow_the_line_order(spark, folder, rows, most_rows):
    numbered = numbered_rows(spark, folder, most_rows)
    wanted = assign_surrogate_keys(passenger_rows(spark, folder), line_order(), "index_col").select(*numbered.columns)
    assert rows(numbered) == rows(wanted)
    assert numbered.agg(F.max("index_col"), F.count_distinct("index_col"), F.count("*")).first() == (wanted.count(),) * 3


def test_wide_rows_are_not_dealt_by_ranges(spark, folder):
    plan = numbered_rows(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "WindowGroupLimit" not in plan


@pytest.mark.parametrize("small", [star.SMALL, 0])
def test_star_of_written_lines(spark, folder, rows, monkeypatch, small):
    monkeypatch.setattr(star, "SMALL", small)
    sketched, sketch = [], star.hot_keys_of_written
    monkeypatch.setattr(star, "hot_keys_of_written", lambda df, keys: sketched.extend(keys) or sketch(df, keys))
    built, core = whole_star(spark, folder), passenger_rows(spark, folder)
    # Dimensions that are broadcast need no search for hot keys.
    assert sorted(sketched) == ([] if small else sorted(star.LOOKUPS))
    plain = {name: star.build_dimension(core, plan, tie_break()) for name, plan in star.DIMENSION_PLANS.items()}
    for name, dim in plain.items():
        assert rows(built[name]) == rows(dim.select(*built[name].columns))
    assert rows(built[FACT.name]) == rows(star.fact_rows(core, plain))


def test_the_last_day_of_a_key_is_enough(spark, rows):
    made = ["if(id % 7 = 0, null, concat('A', id % 5)) arrival_airport", "concat('N', id) airport_name", "'C' airport_country_code",
            "'X' country_name", "'E' airport_continent", "'EUROPE' continents"]
    day = "if(id % 5 = 1 or id % 3 = 0, null, date_add(date'1995-01-01', cast(id % 40 as int))) departure_date"
    core = spark.range(400).selectExpr(*made, day, "id")
    plan = star.AIRPORT_PLAN
    kept = plan.on_last_day(core)
    assert kept.count() < core.count()
    assert rows(plan.latest(kept, ["id desc"])) == rows(plan.latest(core, ["id desc"]))
