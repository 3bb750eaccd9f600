"""Every named query against its oracle SQL on the smallest tables."""

import pytest
from compare import DATA, difference, oracle_connection

import __spark_entry__ as entry
from tsubo.plans import registry

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, oracle, name):
    rows = entry.queries()[name](spark, FOLDER).toPandas()
    assert difference(rows, oracle.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
