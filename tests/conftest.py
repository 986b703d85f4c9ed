from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from podium.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "podium-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Literal rows under a DDL schema."""
    def make(schema, *values):
        return spark.createDataFrame(list(values), schema)
    return make


def as_set(df, *cols):
    return {tuple(r) for r in (df.select(*cols) if cols else df).collect()}


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}
