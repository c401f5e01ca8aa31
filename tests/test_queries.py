"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_matches_sql(spark, connection, name):
    sql = driver.oracle_sql().get(name)
    df = driver.queries()[name](spark, SF_DIR)
    if sql is None:
        assert df.count() >= 0
    else:
        assert differences(df, connection, sql) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
