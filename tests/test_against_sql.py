"""Every query next to its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as driver
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables are not there")
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    problem, _ = compare(spark, con, SF_DIR, QUERIES[name], SQL[name])
    assert not problem, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_some_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
