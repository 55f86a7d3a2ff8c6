"""Every check query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from checkqueries.registry import ORACLES, QUERIES
from compare import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in ORACLES, "a query without SQL needs its own test"
    assert difference(spark, con, QUERIES[name], ORACLES[name], FOLDER) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.count() > 0
