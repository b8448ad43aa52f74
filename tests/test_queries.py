"""Every registered query of the library runs; those with an SQL form equal it."""

import pytest

from broadloom import queries
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, queries.QUERIES[name], queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, sf_dir, name):
    assert len(queries.QUERIES[name](spark, sf_dir).toPandas()) > 0
