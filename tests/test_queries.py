"""Every registered query against its SQL, to the last bit."""

import pytest

import __spark_entry__ as driver
from conftest import MEDIUM, SMALL
from testbed.compare import connect, difference, rows_of_duckdb, rows_of_spark

ORACLE = driver.registry.ORACLE
QUERIES = {name: driver.queries()[name] for name in driver.registry.QUERIES}
# Cohorts are thin at the smallest scale.
MEDIUM_QUERIES = ["cohort_totals", "cohort_breakeven", "cohort_breakeven_bing", "search_event_log", "display_event_log"]


@pytest.fixture(scope="module")
def duck():
    return {folder: connect(folder) for folder in (SMALL, MEDIUM)}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def check(spark, duck, folder, name):
    found = rows_of_spark(QUERIES[name](spark, folder))
    assert difference(found, rows_of_duckdb(duck[folder], ORACLE[name])) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_small(spark, duck, name):
    check(spark, duck, SMALL, name)


@pytest.mark.parametrize("name", MEDIUM_QUERIES)
def test_medium(spark, duck, name):
    check(spark, duck, MEDIUM, name)


def test_entry(spark):
    assert driver.entry(spark).columns == ["week", "type", "value"]
