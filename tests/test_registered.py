import pytest

import __spark_entry__ as driver
from checks.compare import differences, duck
from checks.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_equal_to_sql(spark, connection, name):
    assert differences(spark, connection, FOLDER, name) == []


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
