"""Every registered query against its SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tickbars.plans.catalog import catalog
from tickbars.plans.feed import Feed
from tickbars.plans.oracle import oracle
from tests.compare import compare, connect

QUERIES = catalog()
SQL = oracle()


@pytest.fixture(scope="module")
def con(sf_dir) -> duckdb.DuckDBPyConnection:
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:4] == ["bar_id", "symbol", "start_ts_ms", "end_ts_ms"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) == []


def test_chunked_lane_gives_the_same_bars(spark, sf_dir):
    """The registered pipeline with many small chunks, as a large input would have."""
    whole, cut = Feed(spark, sf_dir), Feed(spark, sf_dir, rows_per_chunk=40)
    columns = [c for c in whole.bars.columns if c != "grain_ms"]
    left, right = whole.bars.select(*columns), cut.bars.select(*columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_plans_have_no_cross_join_and_no_python(spark, sf_dir):
    """No nested-loop or Cartesian join, and nothing leaves the JVM."""
    for name, run in QUERIES.items():
        plan = run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert operator not in plan, (name, operator)


def test_rollups_share_one_shuffle(spark, sf_dir):
    feed = Feed(spark, sf_dir)
    plan, before = (f._jdf.queryExecution().executedPlan().toString() for f in (feed.aligned, feed.bins))
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange") == before.count("Exchange") + 1
