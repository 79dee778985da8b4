"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as driver
from compare import connect, spark_rows, sql_rows

from refgauge.plans.oracles import ORACLES
from refgauge.plans.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, db, name):
    names, rows = spark_rows(QUERIES[name](spark, sf))
    sql_names, expected = sql_rows(db, ORACLES[name])
    assert names == sql_names
    assert rows == expected
    assert rows


def test_entry(spark):
    assert driver.entry(spark).count() > 0
