"""Every registered query against its SQL twin in DuckDB, on whole tables."""

import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from daywise.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_each_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    frame = queries()[name](spark, SF)
    assert differences(frame, db, oracle_sql()[name]) == []


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[0] == "use_date"
    assert frame.count() > 0
