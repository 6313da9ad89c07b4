"""Every registered query against its oracle on the driver's tables."""

import os

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry
from featureloom.catalog import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["name", "label", "features"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    equal, message, rows = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert equal, message
    assert rows > 0
