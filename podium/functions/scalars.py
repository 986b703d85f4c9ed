"""Scalar expressions shared by the models."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a null part inside a surrogate key.
NULL_TOKEN = "_null_"


def safe_ratio(num: str, den: str, digits: int = 4) -> Column:
    """``num / den`` rounded, null unless the denominator is positive. Both are SQL text."""
    return F.expr(
        f"CASE WHEN ({den}) > 0 THEN round(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE), {digits}) END")


def win_value(won: str | Column, weight: Column | float = 1.0) -> Column:
    """A win counts as ``weight``; a loss or an unknown result as 0."""
    weight = weight if isinstance(weight, Column) else F.lit(float(weight))
    return F.when(_col(won), weight).otherwise(F.lit(0.0))


def opponent_strength(rating: str | Column) -> Column:
    """Weight of an opponent by rating: 1.0 at rating 7, kept within 0.5-2.0, 1.0 if unknown."""
    raw = F.lit(1.0) + (_col(rating) - 7.0) / 10.0
    return F.when(_col(rating).isNull(), 1.0).otherwise(F.least(F.lit(2.0), F.greatest(F.lit(0.5), raw)))


def week_start(date: str | Column) -> Column:
    return F.to_date(F.date_trunc("week", _col(date)))


def month_start(date: str | Column) -> Column:
    return F.to_date(F.date_trunc("month", _col(date)))


def year_month(date: str | Column) -> Column:
    return F.date_format(_col(date), "yyyy-MM")


def with_calendar(df: DataFrame, date: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_week``, ``<prefix>_month`` (dates) and ``<prefix>_year_month`` (text)."""
    return df.withColumns({
        f"{prefix}_week": week_start(date),
        f"{prefix}_month": month_start(date),
        f"{prefix}_year_month": year_month(date),
    })


def surrogate_key(*cols: str | Column) -> Column:
    """Hash of the parts joined by ``-``; null parts keep their place."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def deterministic_id(*cols: str | Column) -> Column:
    """Repeatable identity: a retried task gives the same id, unlike a random one."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)


def classify_trend(change: str | Column, threshold: float = 2.0) -> Column:
    change = _col(change)
    return (F.when(change > threshold, "improving")
            .when(change < -threshold, "declining")
            .otherwise("stable"))


def rescale(value: str | Column, low: Decimal, high: Decimal) -> Column:
    """Position of ``value`` between ``low`` and ``high`` as 0-100, clamped, not rounded.

    ``least``/``greatest`` skip nulls, so fill nulls (:func:`fill_defaults`) first.
    """
    scaled = (_col(value) - F.lit(low)) / F.lit(high - low) * 100
    return F.least(F.lit(100), F.greatest(F.lit(0), scaled))


def capped(value: str | Column, factor: int) -> Column:
    """``value * factor`` with an upper limit of 100 only, not rounded."""
    return F.least(F.lit(100), _col(value) * factor)


def weighted_score(weights: Mapping[str, Decimal], digits: int = 2) -> Column:
    """Weighted sum of component columns in the order given, rounded once at the end."""
    terms = [F.col(name) * F.lit(weight) for name, weight in weights.items()]
    return F.round(reduce(lambda a, b: a + b, terms), digits)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
        for name, value in defaults.items()
    })


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def percent_label(value: str | Column, digits: int = 1) -> Column:
    text = F.concat(F.round(_col(value) * 100, digits).cast("string"), F.lit("%"))
    return F.coalesce(text, F.lit("N/A"))


def map_values(value: str | Column, mapping: Mapping[object, str], default: str) -> Column:
    """Label for each known value; ``default`` for any other and for null."""
    value = _col(value)
    labelled = None
    for key, label in mapping.items():
        labelled = F.when(value == F.lit(key), label) if labelled is None \
            else labelled.when(value == F.lit(key), label)
    return F.lit(default) if labelled is None else labelled.otherwise(default)


def rank_of(value: str | Column, ranks: tuple[str, ...]) -> Column:
    """1 for the first listed value, 2 for the next, and one more than the last for the rest."""
    value = _col(value)
    order = F.lit(len(ranks) + 1)
    for place, name in reversed(list(enumerate(ranks, start=1))):
        order = F.when(value == name, F.lit(place)).otherwise(order)
    return order


def confidence_band(value: str | Column) -> Column:
    value = _col(value)
    return F.when(value < 0.6, "low").when(value < 0.8, "medium").otherwise("high")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
