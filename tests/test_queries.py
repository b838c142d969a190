"""Every query against its SQL form on the smallest tables."""

import pytest

import __spark_entry__ as entry
from chronolex.plans import all_queries
from compare import difference, duck

# The engine's own queries; the operators of the training-data package have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in all_queries.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def connection():
    return duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, connection, name):
    assert difference(QUERIES[name](spark, sf), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
