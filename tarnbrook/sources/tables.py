"""Tables kept as a change log in parquet: what MERGE, change capture and time travel need.

A table folder holds ``log/_version=N`` (the change rows of one statement),
``base-…`` folders (whole states, from replacing or compacting) and ``commits``
(one JSON row per version, written last). Readers look at committed versions
only, so a statement takes effect as a whole or not at all, and a statement
that died half-way is overwritten by its retry. Each table has one writer.

A statement writes its changes and not the table: the cost of a load follows
the batch. Versions are never rewritten, so every earlier state stays readable.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, fields
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnbrook.functions.keys import row_id
from tarnbrook.operators.changes import collapse
from tarnbrook.operators.merge import ACTION, IS_UPDATE, change_counters
from tarnbrook.schemas import TableSpec
from tarnbrook.session import COMPRESSION, path_exists, writing

# Up to this many removed keys are broadcast when a state is read; the commit
# records hold the exact count.
BROADCAST_KEYS = 200_000


def _now() -> datetime:
    """Now in whole milliseconds, the precision of a timestamp in JSON."""
    now = datetime.now(timezone.utc)
    return now.replace(microsecond=now.microsecond // 1000 * 1000)


@dataclass(frozen=True)
class Commit:
    version: int
    commit_ts: datetime
    statement_id: str
    kind: str
    batch_id: str | None = None
    source_version: int | None = None
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    rows: int = 0
    high_key: int = 0
    base_version: int = 0
    base_path: str | None = None
    base_source_version: int | None = None

    @property
    def rows_affected(self) -> int:
        return self.inserted + self.updated + self.deleted


_COMMIT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "commit_ts"
                      else T.StringType() if "str" in str(f.type) else T.LongType())
        for f in fields(Commit)
    ]
)


def _append_json(spark: SparkSession, rows: list[dict], folder: str) -> None:
    """Add one file with a few JSON rows; it appears as a whole when its task commits."""
    lines = "\n".join(json.dumps(r, default=lambda moment: moment.isoformat(timespec="milliseconds")) for r in rows)
    spark.range(0, 1, 1, 1).select(F.lit(lines).alias("value")).write.mode("append").text(folder)


class LogTable:
    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, extra: dict[str, T.DataType] | None = None):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.extra = extra or {}
        self.keys = list(spec.key)
        self.refresh()

    # -- commits -----------------------------------------------------------

    def refresh(self) -> None:
        """Load the commit rows: metadata, one small row per statement."""
        known = path_exists(self.spark, f"{self.path}/commits")
        rows = self.commits().orderBy("version").collect() if known else []
        self._commits = [Commit(**{**r.asDict(), "commit_ts": r["commit_ts"].astimezone(timezone.utc)}) for r in rows]

    def commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMIT_SCHEMA).json(f"{self.path}/commits")

    @property
    def head(self) -> Commit | None:
        return self._commits[-1] if self._commits else None

    @property
    def version(self) -> int:
        return self.head.version if self.head else 0

    @property
    def rows(self) -> int:
        """Number of rows now, from the commit rows."""
        return self.head.rows if self.head else 0

    @property
    def source_version(self) -> int:
        """How far this table has consumed its source: stored in its own commits,
        so taking a change and remembering it is one act."""
        return max((c.source_version for c in self._commits if c.source_version is not None), default=0)

    def version_for_source(self, source_version: int) -> int:
        """Own version that had consumed the source up to ``source_version``."""
        return max((c.version for c in self._commits if (c.source_version or 0) <= source_version), default=0)

    @property
    def high_key(self) -> int:
        """Highest surrogate key ever given out; deletes do not free keys."""
        return self.head.high_key if self.head else 0

    def has_batch(self, batch_id: str) -> bool:
        return any(c.batch_id == batch_id for c in self._commits)

    def version_at(self, moment: datetime) -> int:
        """Last version at ``moment`` (UTC if it names no zone)."""
        moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        return max((c.version for c in self._commits if c.commit_ts <= moment), default=0)

    def version_before(self, statement_id: str) -> int:
        """Version before a statement, found in the commit rows, which other processes may have added to."""
        stated = self.commits().where(F.col("statement_id") == statement_id)
        version = stated.agg(F.min("version")).first()[0]
        if version is None:
            raise KeyError(f"{self.spec.name} has no statement {statement_id}")
        return version - 1

    def _commit(self, kind: str, **values) -> Commit:
        previous = self.head
        carried = {} if previous is None else {
            k: getattr(previous, k) for k in ("rows", "high_key", "base_version", "base_path", "base_source_version")
        }
        commit = Commit(
            version=self.version + 1,
            commit_ts=_now(),
            statement_id=values.pop("statement_id", None) or uuid.uuid4().hex,
            kind=kind,
            **{**carried, **values},
        )
        _append_json(self.spark, [asdict(commit)], f"{self.path}/commits")
        self._commits.append(commit)
        return commit

    # -- writing -----------------------------------------------------------

    def apply(self, changes: DataFrame, kind: str = "merge", high_key_from_inserts: bool = False, **commit) -> Commit:
        """Commit change rows as the next version; counts come out of the write itself.

        The counters sit in the stage that writes, so a re-run map stage is not
        counted twice.
        """
        columns = [*self.spec.columns, *self.extra]
        rows = changes.select(*columns, ACTION, IS_UPDATE)
        seen = Observation()
        with writing(rows.sparkSession):
            rows.observe(seen, *change_counters()).write.mode("overwrite").option("compression", COMPRESSION).parquet(self._log_path(self.version + 1))
        counts = {k: int(seen.get.get(k) or 0) for k in ("inserted", "updated", "deleted")}
        commit["rows"] = self.rows + counts["inserted"] - counts["deleted"]
        if high_key_from_inserts:
            commit["high_key"] = self.high_key + counts["inserted"]
        return self._commit(kind, **counts, **commit)

    def append(self, rows: DataFrame, **commit) -> Commit:
        """INSERT … SELECT."""
        return self.apply(as_inserts(rows), kind="append", **commit)

    def replace(self, rows: DataFrame, **commit) -> Commit:
        """TRUNCATE and INSERT … SELECT as one statement; ``rows`` may come from the table itself."""
        version = self.version + 1
        path = f"{self.path}/base-{version}-{uuid.uuid4().hex}"
        seen = Observation()
        with writing(rows.sparkSession):
            rows.select(*self.spec.columns, *self.extra).observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", COMPRESSION).parquet(path)
        rows_now = int(seen.get.get("n") or 0)
        return self._commit("replace", inserted=rows_now, rows=rows_now, base_version=version, base_path=path,
                            base_source_version=None, **commit)

    def compact(self) -> Commit | None:
        """Write the current state as a new base; earlier versions stay readable."""
        if self.head is None:
            return None
        version = self.version + 1
        path = f"{self.path}/base-{version}-{uuid.uuid4().hex}"
        with writing(self.spark):
            self.read().write.option("compression", COMPRESSION).parquet(path)
        return self._commit("compact", base_version=version, base_path=path, base_source_version=None)

    # -- reading -----------------------------------------------------------

    def _log_path(self, version: int) -> str:
        return f"{self.path}/log/_version={version}"

    def _log_commits(self, after: int, upto: int) -> list[Commit]:
        return [c for c in self._commits if after < c.version <= upto and c.kind in ("merge", "append")
                and c.rows_affected]

    def _log_schema(self) -> T.StructType:
        columns = {**self.spec.columns, **self.extra, ACTION: T.StringType(), IS_UPDATE: T.BooleanType(),
                   "_version": T.LongType()}
        return T.StructType([T.StructField(n, t) for n, t in columns.items()])

    def _log(self, commits: list[Commit]) -> DataFrame:
        schema = self._log_schema()
        if not commits:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/log")
        return reader.parquet(*[self._log_path(c.version) for c in commits])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of ``version`` (now, if None).

        Without removals since the base this is a plain scan. Otherwise a row
        falls away if its key was removed in a later version, or in its own one
        unless it is the new half of an update.
        """
        columns = [*self.spec.columns, *self.extra]
        at = self.version if version is None else version
        known = [c for c in self._commits if c.version == at]
        if not known:
            if at == 0:
                return self.spark.createDataFrame([], self._log_schema()).select(*columns)
            raise KeyError(f"{self.spec.name} has no version {at}")
        base = self._base(known[0])
        commits = self._log_commits(known[0].base_version, at)
        log = self._log(commits)
        fresh = log.where(F.col(ACTION) == "INSERT")
        removals = [c for c in commits if c.deleted or c.updated]
        if not removals:
            rows = fresh.select(*columns)
            return rows if base is None else base.unionByName(rows) if commits else base
        gone = (
            self._log(removals).where(F.col(ACTION) == "DELETE")
            .groupBy(*self.keys).agg(F.max("_version").alias("_gone"))
        )
        if sum(c.deleted + c.updated for c in removals) <= BROADCAST_KEYS:
            gone = F.broadcast(gone)
        rows = fresh.select(*columns, "_version", IS_UPDATE)
        if base is not None:
            rows = rows.unionByName(
                base.withColumn("_version", F.lit(known[0].base_version).cast("long")).withColumn(IS_UPDATE, F.lit(False))
            )
        later = F.col("_version") > F.col("_gone")
        renewed = (F.col("_version") == F.col("_gone")) & F.col(IS_UPDATE)
        return rows.join(gone, self.keys, "left").where(F.col("_gone").isNull() | later | renewed).select(*columns)

    def _base(self, commit: Commit) -> DataFrame | None:
        if commit.base_path is None:
            return None
        if commit.base_source_version is not None:
            return LogTable(self.spark, commit.base_path, self.spec, self.extra).read(commit.base_source_version)
        schema = T.StructType([T.StructField(n, t) for n, t in {**self.spec.columns, **self.extra}.items()])
        return self.spark.read.schema(schema).parquet(commit.base_path)

    def at(self, moment: datetime) -> DataFrame:
        """State at a moment."""
        return self.read(self.version_at(moment))

    def before(self, statement_id: str) -> DataFrame:
        """State just before a statement."""
        return self.read(self.version_before(statement_id))

    def changes(self, after: int, upto: int | None = None) -> DataFrame:
        """Net change rows of the versions in (after, upto], with ``_row_id``.

        One version is its own net change; over several, changes of one key collapse.
        """
        commits = self._log_commits(after, self.version if upto is None else upto)
        log = self._log(commits)
        columns = [*self.spec.columns, *self.extra]
        if _collapse(commits):
            return collapse(log, self.keys, columns).select(*columns, ACTION, IS_UPDATE, "_row_id")
        identity = self.keys or ["_version", *columns]
        return log.select(*columns, ACTION, IS_UPDATE, F.expr(row_id(identity)).alias("_row_id"))

    def collapses(self, after: int, upto: int | None = None) -> bool:
        """Do ``changes`` over this interval need a grouping, known from the commit rows?"""
        return _collapse(self._log_commits(after, self.version if upto is None else upto))

    def change_counts(self, after: int, upto: int | None = None) -> Commit:
        """Counters over an interval, from the commit rows alone."""
        commits = self._log_commits(after, self.version if upto is None else upto)
        return Commit(0, _now(), "", "", **{
            k: sum(getattr(c, k) for c in commits) for k in ("inserted", "updated", "deleted")
        })


def _collapse(commits: list[Commit]) -> bool:
    return len(commits) > 1 and any(c.deleted or c.updated for c in commits)


def as_inserts(rows: DataFrame) -> DataFrame:
    return rows.withColumn(ACTION, F.lit("INSERT")).withColumn(IS_UPDATE, F.lit(False))


# -- names, drop and undrop ------------------------------------------------

_REGISTRY_SCHEMA = "table string, location string, event string, event_no long, event_ts timestamp"


def live_state(events: DataFrame, keys: list[str], order: list[str], event: str, drop: str) -> DataFrame:
    """Last event per name in ``order`` (total per name) and whether the name is alive after it."""
    last = events.groupBy(*keys).agg(F.max_by(event, F.struct(*order)).alias("last_event"))
    return last.withColumn("live", F.col("last_event") != drop)


class Catalog:
    """Table names under one root. Dropping only marks a name; undropping lifts the mark."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        known = path_exists(spark, f"{self.root}/registry")
        rows = self.registry().orderBy("event_no").collect() if known else []
        self._events = [(r["table"], r["location"], r["event"]) for r in rows]

    def registry(self) -> DataFrame:
        return self.spark.read.schema(_REGISTRY_SCHEMA).json(f"{self.root}/registry")

    def _record(self, entries: list[tuple[str, str, str]]) -> None:
        start, now = len(self._events), datetime.now(timezone.utc)
        rows = [
            {"table": t, "location": l, "event": e, "event_no": start + n, "event_ts": now}
            for n, (t, l, e) in enumerate(entries)
        ]
        _append_json(self.spark, rows, f"{self.root}/registry")
        self._events += entries

    def location(self, name: str) -> str | None:
        last = [e for e in self._events if e[0] == name][-1:]
        return last[0][1] if last and last[0][2] != "DROP" else None

    def _new_location(self, name: str) -> str:
        return f"{name.replace('.', '/')}/{sum(e[0] == name and e[2] == 'CREATE' for e in self._events)}"

    def ensure(self, *specs: TableSpec) -> None:
        """CREATE TABLE IF NOT EXISTS."""
        missing = [(s.name, self._new_location(s.name), "CREATE") for s in specs if self.location(s.name) is None]
        if missing:
            self._record(missing)

    def table(self, spec: TableSpec, name: str | None = None, extra: dict[str, T.DataType] | None = None) -> LogTable:
        location = self.location(name or spec.name)
        if location is None:
            raise KeyError(f"no table {name or spec.name}")
        return LogTable(self.spark, f"{self.root}/{location}", spec, extra)

    def drop(self, name: str) -> None:
        location = self.location(name)
        if location is None:
            raise KeyError(f"no table {name}")
        self._record([(name, location, "DROP")])

    def undrop(self, name: str) -> None:
        """Bring back the last dropped table of this name."""
        if self.location(name) is not None:
            raise ValueError(f"{name} exists; drop or rename it first")
        dropped = [e for e in self._events if e[0] == name and e[2] == "DROP"][-1:]
        if not dropped:
            raise KeyError(f"no dropped table {name}")
        self._record([(name, dropped[0][1], "UNDROP")])

    def clone(self, name: str, source: LogTable, moment: datetime | None = None, copy: bool = False) -> LogTable:
        """A new table with ``source``'s state at ``moment``.

        The clone refers to the source's version, which never changes, and copies
        no data; ``copy`` writes it out instead.
        """
        if self.location(name) is not None:
            raise ValueError(f"{name} exists")
        version = source.version if moment is None else source.version_at(moment)
        self._record([(name, self._new_location(name), "CREATE")])
        clone = self.table(source.spec, name, source.extra)
        if copy:
            clone.replace(source.read(version), high_key=source.high_key)
        elif version:
            rows = next(c.rows for c in source._commits if c.version == version)
            clone._commit("clone", rows=rows, base_version=1, base_path=source.path, base_source_version=version,
                          high_key=source.high_key)
        return clone


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
