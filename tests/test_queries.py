"""Every registered query against its comparison SQL."""

import pytest

import __spark_entry__ as driver
from compare import difference
from quakeframe.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) == set(ORACLES)
    assert driver.entry(spark).count() > 0
