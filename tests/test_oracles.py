import pytest

from recordloom import queries as engine

from .oracle import connect, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(engine.QUERIES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    same(spark, con, sf_dir, engine.QUERIES[name], engine.ORACLES[name])


def test_entry_is_readable():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(engine.QUERIES) <= set(entry.queries())
