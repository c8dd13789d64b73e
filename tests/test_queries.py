"""Every named query against SQL run by another engine on the same tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as driver
from gridtide.plans.catalog import QUERIES
from gridtide.plans.check_sql import SQL


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], connection) == []


def test_every_query_is_checked():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    days = driver.entry(spark)
    assert days.columns == ["day", "peak_load", "peak_time", "min_load", "min_time"]
    assert days.count() == 10
