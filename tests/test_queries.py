"""Every registered query against its SQL on the same files."""

import pytest

import __spark_entry__ as driver
from shopstrata.checks.oracle import ORACLE
from shopstrata.checks.queries import QUERIES
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def duck(sample_dir):
    return connect(sample_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sample_dir, name):
    rows = driver.queries()[name](spark, sample_dir)
    assert difference(rows, duck, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
