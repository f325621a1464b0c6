"""Every registered query against its SQL, on the smallest tables; the contract of the entry module."""

import os

import pytest

import __spark_entry__ as entry
from carbonloom.queries import QUERIES
from check_oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problems = [p for p in compare(spark, con, name, SF_DIR) if not p.startswith("(")]
    assert not problems


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.count() > 0
