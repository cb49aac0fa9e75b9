"""Registered queries against their SQL, where SQL can express them."""

import os

import pytest
from compare import compare, connect

from courtlake.llm.oracle import SQL
from courtlake.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None
