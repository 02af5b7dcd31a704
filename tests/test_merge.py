"""Merge semantics: the literal clauses, their intent, and a model in plain Python."""

import random

import pytest

from tarnbrook.operators.merge import Matched, Merge, NotMatched, count_changes, from_source, rows_affected
from tarnbrook.plans.star import (
    checked_core_merge, core_merge, literal_dimension_merge, literal_fact_merge, scd1_merge,
)
from tarnbrook.schemas import FACT, INT, LONG, STRING, TableSpec

CORE = TableSpec("core", {"k": LONG, "fixed": STRING, "v": STRING}, key=("k",))
DIM = TableSpec("dim", {"sk": LONG, "k": STRING, "v": STRING}, key=("k",), surrogate="sk")
SOURCE = "k long, fixed string, v string, _action string, _is_update boolean"


def core_tables(spark, target, source):
    return (
        spark.createDataFrame(target, CORE.schema),
        spark.createDataFrame(source, SOURCE),
    )


def counters(merge):
    return tuple(rows_affected(merge.metrics()).first())


def test_core_update_needs_the_flag_and_keeps_fixed_columns(spark, rows):
    target, source = core_tables(
        spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")],
        [(1, "A", "X", "INSERT", True), (2, "B", "Y", "INSERT", False), (3, None, None, "DELETE", False)],
    )
    merge = core_merge(target, source, CORE, fixed=("fixed",))
    assert rows(merge.result()) == [(1, "a", "X"), (2, "b", "y")]  # first write wins for 2
    assert counters(merge) == (0, 1, 1, 2)
    whole = checked_core_merge(target, source, CORE)
    assert rows(whole.result()) == [(1, "A", "X"), (2, "b", "y")]


def test_core_inserts_repeats_and_unknown_deletes_literally(spark, rows):
    target, source = core_tables(
        spark, [(1, "a", "x")],
        [(2, "b", "y", "INSERT", False), (2, "c", "z", "INSERT", False), (3, "d", "w", "DELETE", False)],
    )
    merge = core_merge(target, source, CORE)
    assert rows(merge.result()) == [(1, "a", "x"), (2, "b", "y"), (2, "c", "z"), (3, "d", "w")]
    assert counters(merge) == (3, 0, 0, 3)
    one = source.where("v <> 'z'")
    assert rows(checked_core_merge(target, one, CORE).result()) == [(1, "a", "x"), (2, "b", "y")]


def test_null_keys_match_nothing(spark, rows):
    target, source = core_tables(
        spark, [(None, "a", "x")], [(None, "b", "y", "INSERT", True), (None, "c", "z", "INSERT", True)]
    )
    assert rows(core_merge(target, source, CORE).result()) == [(None, "a", "x"), (None, "b", "y"), (None, "c", "z")]
    assert rows(checked_core_merge(target, source, CORE).result(), "v") == [("x",), ("y",), ("z",)]
    assert counters(checked_core_merge(target, source, CORE)) == (2, 0, 0, 2)


@pytest.mark.parametrize("second", [("INSERT", True), ("DELETE", False)])
def test_contradicting_rows_stop_the_merge(spark, second):
    target, source = core_tables(spark, [(1, "a", "x")], [(1, "b", "y", "INSERT", True), (1, "c", "z", *second)])
    for plan in (core_merge(target, source, CORE).result(), core_merge(target, source, CORE).changes()):
        with pytest.raises(Exception, match="several source rows change one target row"):
            plan.collect()


def test_contradicting_rows_without_a_target_are_inserts(spark, rows):
    target, source = core_tables(spark, [], [(1, "b", "y", "INSERT", True), (1, "c", "z", "INSERT", True)])
    assert rows(core_merge(target, source, CORE).result(), "v") == [("y",), ("z",)]


def test_several_deletes_of_one_row_are_fine(spark, rows):
    target, source = core_tables(spark, [(1, "a", "x")], [(1, "b", "y", "DELETE", False), (1, "c", "z", "DELETE", False)])
    merge = core_merge(target, source, CORE)
    assert rows(merge.result()) == []
    assert counters(merge) == (0, 0, 1, 1)


def test_repeated_target_rows_each_change(spark, rows):
    target, source = core_tables(spark, [(1, "a", "x"), (1, "b", "y")], [(1, "c", "z", "INSERT", True)])
    merge = core_merge(target, source, CORE, fixed=("fixed",))
    assert rows(merge.result()) == [(1, "a", "z"), (1, "b", "z")]
    assert counters(merge) == (0, 2, 0, 2)


def dimension(spark, target, source):
    return (
        spark.createDataFrame(target, DIM.schema),
        spark.createDataFrame(source, "k string, v string, _action string"),
    )


def test_literal_dimensions_never_update(spark, rows):
    target, source = dimension(
        spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")],
        [("a", "X", "INSERT"), ("b", "Y", "DELETE"), ("d", "W", "INSERT"), ("e", "V", "DELETE")],
    )
    merge = literal_dimension_merge(target, source, DIM)
    assert rows(merge.result()) == [(1, "a", "x"), (3, "c", "z"), (None, "d", "W")]
    named = literal_dimension_merge(target, source.replace("INSERT", "UPDATE", "_action"), DIM)
    assert rows(named.result()) == [(1, "a", "X"), (3, "c", "z")]


def test_scd1_overwrites_and_leaves_equal_rows_alone(spark, rows):
    target, source = dimension(
        spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", None)],
        [("a", "X", "INSERT"), ("b", "y", "INSERT"), ("c", None, "INSERT"), ("d", "W", "INSERT")],
    )
    merge = scd1_merge(target, source, DIM)
    assert rows(merge.result()) == [(1, "a", "X"), (2, "b", "y"), (3, "c", None), (None, "d", "W")]
    assert counters(merge) == (1, 1, 0, 2)
    assert counters(scd1_merge(target, source, DIM, skip_equal=False)) == (1, 3, 0, 4)


def test_literal_facts_are_only_added(spark, rows):
    def fact(id_, status):
        return (id_, 1, 1, 1, 1, status, "t")

    target = spark.createDataFrame([fact("a", "old")], FACT.schema)
    source = spark.createDataFrame(
        [(*fact("a", "new"), "INSERT"), (*fact("b", "x"), "INSERT"), (*fact("b", "y"), "INSERT")],
        FACT.schema.add("_action", "string"),
    )
    merge = literal_fact_merge(target, source)
    assert rows(merge.result(), "id", "passenger_status") == [("a", "old"), ("b", "x"), ("b", "y")]


def apply(target, changes):
    """Change rows applied to a list of rows."""
    left = list(target)
    for *row, action, _ in changes:
        if action == "DELETE":
            left.remove(tuple(row))
    return sorted([*left, *[tuple(r) for *r, action, _ in changes if action == "INSERT"]], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_both_paths_follow_the_model(spark, rows, seed):
    pick = random.Random(seed)
    target = [(k, "t", str(pick.randrange(3))) for k in range(40) if pick.random() < 0.6]
    source = [
        (k, "s", str(pick.randrange(3)), pick.choice(["INSERT", "DELETE"]), pick.random() < 0.5)
        for k in range(40) if pick.random() < 0.6
    ]
    known, expected = {r[0]: r for r in target}, dict((r[0], r) for r in target)
    for k, fixed, v, action, flag in source:
        if k in known:
            if action == "DELETE":
                del expected[k]
            elif flag:
                expected[k] = (k, fixed, v)
        elif action == "INSERT":
            expected[k] = (k, fixed, v)
    wanted = sorted(expected.values(), key=str)
    t, s = core_tables(spark, target, source)
    clauses = dict(
        on=["k"],
        matched=[Matched("s._action = 'DELETE'"), Matched("s._is_update", from_source(["fixed", "v"]))],
        not_matched=NotMatched(from_source(["k", "fixed", "v"]), "s._action = 'INSERT'"),
    )
    for unique in (True, False):
        merge = Merge(t, s, source_is_unique=unique, **clauses)
        assert rows(merge.result()) == wanted
        changes = [tuple(r) for r in merge.changes().collect()]
        assert apply(target, changes) == wanted
        assert sum(count_changes(merge.changes()).first()) == len([c for c in changes if not (c[4] and c[3] == "DELETE")])


def test_conditions_may_see_the_target(spark, rows):
    target, source = core_tables(spark, [(1, "a", "5"), (2, "b", "5")], [(1, "A", "9", "INSERT", True), (2, "B", "3", "INSERT", True)])
    newer = Merge(target, source, ["k"], [Matched("cast(s.v as int) > cast(t.v as int)", {"v": "s.v"})], source_is_unique=True)
    assert rows(newer.result()) == [(1, "a", "9"), (2, "b", "5")]


def test_values_take_the_target_type(spark):
    target = spark.createDataFrame([(1, 5)], TableSpec("t", {"k": LONG, "n": INT}).schema)
    source = spark.createDataFrame([(1, "7"), (2, "8")], "k long, n string")
    merge = Merge(target, source, ["k"], [Matched("true", {"n": "s.n"})], NotMatched(from_source(["k", "n"])), True)
    assert merge.result().dtypes == [("k", "bigint"), ("n", "int")]
    assert sorted(map(tuple, merge.result().collect())) == [(1, 7), (2, 8)]
