"""Every registered query against its reference SQL on the smallest tables."""

import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_reference_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_reference(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).collect() is not None
