"""Every named query against DuckDB over the whole test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from strata.plans import registry
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
