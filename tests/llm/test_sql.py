"""Operators with SQL of their own: links, components and repeated passages, on the driver's smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_near_vectors", "op5_jaccard_join", "op8_substring_dedup"])
def test_rows_equal_sql(spark, name):
    problem, rows, _ = differences(spark, connect(FOLDER), name, FOLDER, entry.queries(), entry.oracle_sql())
    assert problem is None and rows > 0
