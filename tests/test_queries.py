import __spark_entry__ as driver
import compare
import pytest

from topicflow.plans import oracles
from topicflow.plans import queries as registered

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registered.registry(), oracles.sql()


@pytest.fixture(scope="module")
def con():
    return compare.database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    top = driver.entry(spark)
    assert top.columns == ["dayslot", "country", "topic", "count"]
    assert top.count() > 0
