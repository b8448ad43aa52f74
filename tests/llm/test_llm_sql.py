"""Operators with an SQL form equal it."""

import pytest

from broadloom.llm import registry
from tests.oracle import connect, difference


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, sf_dir, name):
    assert difference(spark, connect(sf_dir), sf_dir, registry.QUERIES[name], registry.SQL[name]) is None
