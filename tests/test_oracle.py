"""Every registered query against its SQL text, on whole tables."""

import pytest

import __spark_entry__ as driver
from tabulint.catalog import ORACLES, QUERIES
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def db(sf_medium):
    return connect(sf_medium)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_medium, db, name):
    assert assert_same(QUERIES[name](spark, sf_medium), db, ORACLES[name]) > 0
