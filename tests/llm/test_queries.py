"""Every registered query on the smallest tables: against its SQL where it has one, else that it runs."""

import pytest

from checks.compare import connect, difference
from kindred.llm.oracle import ORACLE
from kindred.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_query_covers_its_table(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
