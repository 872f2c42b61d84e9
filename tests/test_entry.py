import pytest

from compare import compare, connect
from __spark_entry__ import entry, oracle_sql, queries
from query_suite import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    word, _ = compare(spark, con, SF, name, queries()[name], oracle_sql()[name])
    assert not word


def test_entry(spark):
    assert entry(spark).count() == 4836
