"""Runs a query and its SQL counterpart and compares schema and rows, in any order."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)]
    rows = sorted(tuple("NULL" if v is None or v != v else str(v) for v in r) for r in pdf.itertuples(index=False))
    return list(pdf.columns), rows


def differences(spark, con, name: str, folder: str, queries, oracles) -> tuple[str | None, int, float]:
    started = time.perf_counter()
    frame = queries[name](spark, folder)
    types = {c: t for c, t in frame.dtypes}
    rows = frame.collect()
    seconds = time.perf_counter() - started
    columns = sorted(types)
    mine = sorted(tuple("NULL" if r[c] is None else str(r[c]) for c in columns) for r in rows)
    result = con.execute(oracles[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}", len(rows), seconds
    place = [names.index(c) for c in columns]
    theirs = sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in place) for r in result.fetchall())
    if mine != theirs:
        only_mine, only_theirs = sorted(set(mine) - set(theirs))[:3], sorted(set(theirs) - set(mine))[:3]
        return f"{len(mine)} rows against {len(theirs)}; {only_mine} / {only_theirs}", len(rows), seconds
    return None, len(rows), seconds


def main(folder: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    todo = names or list(queries())
    for name in todo:
        try:
            problem, rows, seconds = differences(spark, con, name, folder, queries(), oracle_sql())
            print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} {seconds:.1f}s {problem or ''}", flush=True)
        except Exception as error:  # keep going: this is a report
            print(f"ERR  {name} {type(error).__name__}: {str(error)[-900:]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
