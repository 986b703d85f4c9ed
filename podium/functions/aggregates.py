"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.scalars import _col


def mean_rounded(value: str, digits: int) -> Column:
    """Null-skipping mean, rounded to ``digits``, from an exact sum of the whole values.

    Adding doubles gives a last bit that depends on the order in which tasks finish, and a mean
    that lies half-way between two roundings then flips between runs. A decimal sum is exact in
    any order and still combines before the shuffle. Groups that decimals of 20 whole digits
    cannot hold (NaN, infinities, larger values) take the plain mean, under either ANSI setting.
    ``value`` is SQL text.
    """
    exact = f"try_cast(({value}) as decimal(38, 18))"
    total = f"if(count({exact}) = count({value}), cast(try_sum({exact}) as double), null)"
    return F.expr(f"round(coalesce({total} / nullif(count({value}), 0), avg(cast(({value}) as double))), {digits})")


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; unknown does not."""
    return F.count_if(condition)


def ratio_of(num: Column, den: Column, digits: int = 4) -> Column:
    """Ratio of two aggregates, null when the second is 0."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), digits)


def spread(value: str | Column, digits: int = 2) -> Column:
    return F.round(F.max(_col(value)) - F.min(_col(value)), digits)
