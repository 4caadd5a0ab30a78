"""Registered queries of the subpackage beside their SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tickbars.llm.catalog import catalog, oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_registered():
    assert set(catalog()) <= set(entry.queries()) and set(oracle()) <= set(entry.oracle_sql())
    assert set(oracle()) <= set(catalog())


@pytest.mark.parametrize("name", list(oracle()))
def test_matches_sql(spark, con, sf_dir, name):
    found = compare(spark, con, sf_dir, catalog()[name], oracle()[name])
    assert found == []
