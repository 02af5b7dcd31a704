"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_scope = threading.local()

# The shuffle files of a write are of no use when it has ended. Without this setting they stay on
# the executors' disks until the driver happens to collect garbage.
REMOVE_SHUFFLE_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Of tables and scratch files.
COMPRESSION = "zstd"

_writing_lock = threading.Lock()
# By session: threads inside ``writing``, and whether it made the setting.
_writing: dict[str, tuple[int, bool]] = {}

# Defaults a job can override; partition counts are left to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tarnbrook", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where driver and executors
    share one machine; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tarnbrook-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Inside, a statement of this session that ends takes its shuffle files with it.

    A session that has the setting already is left alone. Several threads may be
    inside; the last one restores the session.
    """
    session = spark._jsparkSession.sessionUUID()
    with _writing_lock:
        inside, ours = _writing.get(session, (0, False))
        if not inside:
            ours = not spark._jsparkSession.conf().getAll().contains(REMOVE_SHUFFLE_FILES)
            if ours:
                spark.conf.set(REMOVE_SHUFFLE_FILES, "true")
        _writing[session] = inside + 1, ours
    try:
        yield
    finally:
        with _writing_lock:
            inside, ours = _writing.pop(session)
            if inside > 1:
                _writing[session] = inside - 1, ours
            elif ours:
                spark.conf.unset(REMOVE_SHUFFLE_FILES)


def materialize(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    This cuts the lineage: lost executors cost a re-read and never a
    recomputation, so sampled range bounds or generated ids cannot change
    between two uses. Readers of the result still prune columns. ``spark`` reads
    it back in another session than that of ``df`` (a micro-batch has its own).
    """
    path = scratch_path(df.sparkSession, label)
    with writing(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


@contextmanager
def scratch_scope(spark: SparkSession, keep_last: bool = False) -> Iterator[None]:
    """Remove what ``materialize`` wrote inside the block (in this thread) when it ends.

    With ``keep_last`` what was written last is the block's result and stays, in the scope around it if there is one.
    """
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
        if keep_last and _scope.paths:
            last = _scope.paths.pop()
            if outer is not None:
                outer.append(last)
    finally:
        for path in _scope.paths:
            files, target = _file_system(spark, path)
            files.delete(target, True)
        _scope.paths = outer


def side_by_side(spark: SparkSession, tasks: list[Callable[[], Any]]) -> list[Any]:
    """Run independent driver calls at once, so that their Spark jobs share the cluster.

    All of them finish before the first error, if any, is raised. A scratch
    scope around the call also covers what they write.
    """
    paths = getattr(_scope, "paths", None)

    def run(task: Callable[[], Any]) -> Any:
        outer, _scope.paths = getattr(_scope, "paths", None), paths
        try:
            return task()
        finally:
            _scope.paths = outer

    with ThreadPoolExecutor(len(tasks)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run), task) for task in tasks]
    return [future.result() for future in started]
