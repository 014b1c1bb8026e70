import pytest

from recordloom.llm import queries

from ..oracle import connect, same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    same(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLES[name])
