"""The registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import database, difference

import __spark_entry__ as registered

QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return database(small)


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small, connection, name):
    assert difference(QUERIES[name](spark, small), connection, ORACLES[name]) is None


def test_entry(spark):
    assert registered.entry(spark).count() == 6
