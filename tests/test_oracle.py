"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["b1", "b2", "sim"] and df.count() > 0
