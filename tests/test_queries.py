"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry_points
from compare import assert_same, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, connection, name):
    assert_same(QUERIES[name](spark, FOLDER), connection, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
