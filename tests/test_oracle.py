"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from courtlake.plans.catalogue import registered
from oracle_queries import oracle_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registered(), oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["team_id", "season"] and df.count() > 0
