"""Registered queries against their SQL, and the base results of the rest against brute force, on whole tables."""

import pytest

import __spark_entry__ as driver
from shopstrata.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None
