import pytest
from conftest import against_sql

from orgloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    got, want = against_sql(spark, sf_dir, registry.QUERIES[name], registry.ORACLES[name])
    assert got == want


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
