import os

import pytest
from check_oracle import compare, oracle_connection

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, driver.queries()[name], driver.oracle_sql()[name], SF) is None


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
