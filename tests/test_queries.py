"""Every query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from suite import queries as suite_queries
from tests.compare import connect, differences

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, SQL[name]) == []


def test_every_query_has_its_sql():
    assert {query.__name__ for query in suite_queries.ALL} <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
