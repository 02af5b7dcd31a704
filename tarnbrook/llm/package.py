"""Make this package importable in the workers of a session."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Add the package to the session, unless the workers share the driver's folders and path.

    Spark's own file server hands the archive to the executors, as for any
    ``--py-files``; nothing else is read from the driver's folder. On a cluster that is
    always done: what the driver can import says nothing about other machines.
    """
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    reachable = local and (str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == ROOT)
    if reachable or getattr(context, "_tarnbrook_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="tarnbrook-package-")) / "tarnbrook_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((ROOT / "tarnbrook").rglob("*.py")):
            out.write(file, file.relative_to(ROOT))
    before = list(sys.path)
    context.addPyFile(str(archive))
    sys.path[:] = before
    context._tarnbrook_shipped = True
