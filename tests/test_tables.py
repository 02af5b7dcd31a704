import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tarnbrook.operators.audit import AuditTrail
from tarnbrook.operators.changes import change_pairs, net_changes
from tarnbrook.schemas import AUDIT, LONG, STRING, TableSpec
from tarnbrook.sources.tables import Catalog, LogTable, live_state

SPEC = TableSpec("stage.users", {"k": LONG, "v": STRING}, key=("k",))


@pytest.fixture
def table(spark, tmp_path):
    return LogTable(spark, str(tmp_path / "users"), SPEC)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SPEC.schema)


def move(spark, table, *rows):
    """Commit the change from the current state to ``rows``."""
    return table.apply(change_pairs(net_changes(table.read(), frame(spark, *rows), ["k"]), ["k"]))


STATES = [
    [(1, "a"), (2, "b")],
    [(1, "A"), (3, "c")],
    [(1, "A"), (2, "back"), (3, "c")],
    [(2, "back"), (3, None)],
]


@pytest.fixture
def history(spark, table):
    commits = []
    for state in STATES:
        commits.append(move(spark, table, *state))
        time.sleep(0.01)
    return table, commits


def test_every_version_stays_readable(spark, history, rows):
    table, commits = history
    for reader in (table, LogTable(spark, table.path, SPEC)):
        assert rows(reader.read(0)) == []
        for version, state in enumerate(STATES, 1):
            assert rows(reader.read(version)) == sorted(state, key=str)
        for commit, state in zip(commits, STATES):
            assert rows(reader.at(commit.commit_ts)) == sorted(state, key=str)
            before = STATES[commit.version - 2] if commit.version > 1 else []
            assert rows(reader.before(commit.statement_id)) == sorted(before, key=str)
        assert rows(reader.at(commits[0].commit_ts - timedelta(seconds=1))) == []
        assert rows(reader.at(datetime.now(timezone.utc).replace(tzinfo=None))) == sorted(STATES[-1], key=str)
    with pytest.raises(KeyError):
        table.before("unknown")
    assert [(c.inserted, c.updated, c.deleted) for c in commits] == [(2, 0, 0), (1, 1, 1), (1, 0, 0), (0, 1, 1)]


def test_changes_between_versions_are_net(spark, history, rows):
    table, _ = history
    for low in range(len(STATES) + 1):
        for high in range(low + 1, len(STATES) + 1):
            a, b = table.read(low), table.read(high)
            wanted = change_pairs(net_changes(a, b, ["k"]), ["k"])
            got = table.changes(low, high)
            columns = ["k", "v", "_action", "_is_update", "_row_id"]
            assert rows(got, *columns) == rows(wanted, *columns), (low, high)
    assert rows(table.changes(len(STATES))) == []


def test_a_dead_statement_leaves_no_trace(spark, table, rows):
    table.append(frame(spark, (1, "a")))
    frame(spark, (9, "ghost")).withColumn("_action", F.lit("INSERT")).withColumn("_is_update", F.lit(False)).write.parquet(
        f"{table.path}/log/_version=2"
    )
    fresh = LogTable(spark, table.path, SPEC)
    assert rows(fresh.read()) == [(1, "a")]
    fresh.append(frame(spark, (2, "b")))
    assert rows(LogTable(spark, table.path, SPEC).read()) == [(1, "a"), (2, "b")]


def test_replace_reads_itself_and_compact_keeps_history(spark, history, rows):
    table, _ = history
    table.compact()
    assert rows(table.read()) == sorted(STATES[-1], key=str)
    move(spark, table, (2, "b2"), (7, "n"))
    assert rows(table.read()) == [(2, "b2"), (7, "n")]
    assert rows(table.read(2)) == sorted(STATES[1], key=str)
    table.replace(table.read().where("k > 2"))
    assert rows(LogTable(spark, table.path, SPEC).read()) == [(7, "n")]
    assert rows(table.read(table.version - 1)) == [(2, "b2"), (7, "n")]
    table.append(frame(spark, (8, "x")))
    assert rows(table.read()) == [(7, "n"), (8, "x")]


def test_empty_changes_commit(spark, table, rows):
    commit = table.append(frame(spark))
    assert commit.rows_affected == 0 and rows(table.read()) == []
    table.append(frame(spark, (1, "a")))
    assert rows(table.read()) == [(1, "a")]


def test_offsets_and_batches_live_in_commits(spark, table):
    table.append(frame(spark, (1, "a")), batch_id="b-0", source_version=3)
    table.append(frame(spark, (2, "a")), batch_id="b-1", source_version=5)
    again = LogTable(spark, table.path, SPEC)
    assert again.source_version == 5 and again.has_batch("b-0") and not again.has_batch("b-2")
    assert again.version_for_source(4) == 1 and again.version_for_source(2) == 0


def test_names_drop_undrop_and_clone(spark, tmp_path, rows):
    root = str(tmp_path / "db")
    catalog = Catalog(spark, root)
    catalog.ensure(SPEC)
    catalog.ensure(SPEC)
    table = catalog.table(SPEC)
    first = table.append(frame(spark, (1, "a")))
    time.sleep(0.01)
    move(spark, table, (2, "b"))
    shallow = catalog.clone("past", table, first.commit_ts)
    deep = catalog.clone("copy", table, first.commit_ts, copy=True)
    assert rows(shallow.read()) == rows(deep.read()) == [(1, "a")]
    shallow.append(frame(spark, (5, "only here")))
    assert rows(table.read()) == [(2, "b")]
    move(spark, table, (3, "c"))
    assert rows(Catalog(spark, root).table(SPEC, "past").read()) == [(1, "a"), (5, "only here")]
    with pytest.raises(ValueError):
        catalog.clone("past", table)
    catalog.drop("past")
    with pytest.raises(KeyError):
        Catalog(spark, root).table(SPEC, "past")
    catalog.undrop("past")
    assert rows(Catalog(spark, root).table(SPEC, "past").read()) == [(1, "a"), (5, "only here")]
    catalog.drop(SPEC.name)
    catalog.ensure(SPEC)
    assert rows(catalog.table(SPEC).read()) == []
    with pytest.raises(ValueError):
        catalog.undrop(SPEC.name)
    catalog.drop(SPEC.name)
    catalog.undrop(SPEC.name)  # the last dropped one comes back
    assert rows(catalog.table(SPEC).read()) == []


def test_live_state(spark, rows):
    events = spark.createDataFrame([("t", 1, "CREATE"), ("t", 2, "DROP"), ("t", 3, "UNDROP"), ("u", 1, "CREATE"), ("u", 4, "DROP")], "name string, n int, event string")
    assert rows(live_state(events, ["name"], ["n"], "event", "DROP")) == [("t", "UNDROP", True), ("u", "DROP", False)]


def test_audit_records_and_lets_errors_through(spark, tmp_path, table):
    trail = AuditTrail(LogTable(spark, str(tmp_path / "audit"), AUDIT))
    trail.run("load", "users", "MERGE", lambda: table.append(frame(spark, (1, "a"), (2, "b"))))

    def fail():
        raise ValueError("it's broken")

    with pytest.raises(ValueError):
        trail.run("load", "users", "MERGE", fail)
    trail.flush()
    trail.run("load", "users", "MERGE", lambda: None)
    trail.flush()
    log = LogTable(spark, str(tmp_path / "audit"), AUDIT).read().orderBy("log_id").collect()
    assert [(r["log_id"], r["rows_affected"], r["error_message"]) for r in log] == [
        (1, 2, None), (2, 0, "it's broken"), (3, 0, None),
    ]
    assert log[0]["query_id"] == table.head.statement_id and log[1]["query_id"] is None
    assert all(r["end_timestamp"] >= r["start_timestamp"] for r in log)
