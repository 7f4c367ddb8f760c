"""Every registered query against its SQL twin on an independent engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from shopflow.plans import registry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.01"
QUERIES, SQL = registry.QUERIES, driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None
