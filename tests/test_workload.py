"""Every registered query against its SQL at the smallest scale, and rules for their plans."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from siltbed.workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


def ordered(rows, columns):
    """Rows with columns by name, sorted on everything but floats first."""
    index = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in index) for row in rows]
    return sorted(rows, key=lambda r: ([repr(x) for x in r if not isinstance(x, float)], repr(r)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = ordered([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = ordered(result.fetchall(), columns)
    assert sorted(columns) == sorted(df.columns)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(close(a, b) for a, b in zip(g, w)), (g, w)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith("gbt_")))
def test_plan_rules(spark, name):
    """No cross join, no row-at-a-time Python, Arrow batches only for HTML."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert ("MapInPandas" in plan) == (name == "html_rows")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "ma_20" in df.columns


def test_scans_read_only_needed_columns(spark):
    def scan(name):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan" in line]

    assert all("props" not in line and "user_id" not in line for line in scan("ohlcv_technical"))
    assert all("html" not in line for line in scan("url_category"))
    assert all("l_comment" not in line and "l_tax" not in line for line in scan("exact_median_hot_groups"))
