"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
import compare
from fleetquill.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["dfcc", "ecu_name"]
    assert df.count() > 0
