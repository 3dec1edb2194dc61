"""Every query with an oracle returns what the oracle returns."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle_connection


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equal(spark, duck, sf_dir, name):
    got = queries()[name](spark, sf_dir).toPandas()
    assert compare(got, duck.execute(oracle_sql()[name]).df()) == ""
    assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
