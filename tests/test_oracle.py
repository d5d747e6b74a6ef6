"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from workload.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    agrees, text = compare(spark, con, SF_DIR, name)
    assert agrees, text
