"""Every registered query against its SQL, over whole tables."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_point
from shipments.catalog import QUERIES
from shipments.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLE.keys() <= entry_point.oracle_sql().keys() <= entry_point.queries().keys()


def test_entry(spark):
    assert entry_point.entry(spark).columns[-1] == "pct_change"


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert compare(df, connection, entry_point.oracle_sql()[name]) is None
