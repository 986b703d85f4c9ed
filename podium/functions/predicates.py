"""Row filters. A comparison with null is unknown, and an unknown row is dropped."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.filter(all_of(F.col(c).isNotNull() for c in cols))


def non_negative(cols: Iterable[str]) -> Column:
    return all_of(F.col(c) >= 0 for c in cols)


def in_range_or_null(col: str, low: float, high: float) -> Column:
    return F.col(col).isNull() | F.col(col).between(low, high)


def in_set_or_null(col: str, values: Iterable[str]) -> Column:
    return F.col(col).isNull() | F.col(col).isin(*values)


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current"))


def not_provenance(col: str, value: str) -> Column:
    """Rows of any other provenance, rows of unknown provenance included."""
    return ~F.col(col).eqNullSafe(F.lit(value))


def below_confidence(threshold: float = 0.8, col: str = "extraction_confidence") -> Column:
    return F.col(col) < F.lit(float(threshold))


def maybe_eq(df: DataFrame, col: str, value: object = "All") -> DataFrame:
    """Equality on a chosen value; the choice ``All`` keeps every row."""
    return df if value == "All" else df.filter(F.col(col) == F.lit(value))
