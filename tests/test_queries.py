"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    connection = connect(folder)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    assert compare(spark, con, name, folder) is None
