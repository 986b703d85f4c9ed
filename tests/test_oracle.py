"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from workload import load

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = load().QUERIES, load().ORACLE


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], SQL[name], SF_DIR) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "development_score" in df.columns
