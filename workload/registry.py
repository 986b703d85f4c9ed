"""Registered queries and the SQL a second engine runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from podium.session import pin_utc
from workload.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of :class:`Tables` under its name."""
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(pin_utc(spark), sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build
    return register
