"""Ranking, lag and rolling operators.

A filter on ``row_number`` is pushed below the shuffle as a per-task group limit, so a hot group
sends at most ``n`` rows per task to the task that ranks it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.scalars import _col
from podium.session import scratch_dir

Order = Sequence[str | Column]


def latest(df: DataFrame, keys: Sequence[str], order: Order, n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of every group in the given order."""
    window = Window.partitionBy(*keys).orderBy(*[_col(o) for o in order])
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def top1(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    return latest(df, keys, order, 1)


def dedupe(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key: the first in a stated order, not whichever arrives first."""
    return top1(df, keys, order)


def with_change(df: DataFrame, keys: Sequence[str], order: Order, value: str,
                previous: str, change: str) -> DataFrame:
    """Value of the previous present row and the difference from it (null on the first row)."""
    window = Window.partitionBy(*keys).orderBy(*[_col(o) for o in order])
    return (df.withColumn(previous, F.lag(value).over(window))
            .withColumn(change, F.col(value) - F.col(previous)))


def rolling_days(df: DataFrame, keys: Sequence[str], day: str, days: int,
                 totals: dict[str, str]) -> DataFrame:
    """Sums over the last ``days`` calendar days, the current one included.

    ``df`` must hold one row per key and day, which bounds a group by the length of the calendar.
    """
    epoch_day = F.unix_date(F.col(day))
    window = Window.partitionBy(*keys).orderBy(epoch_day).rangeBetween(1 - days, 0)
    return df.withColumns({out: F.sum(col).over(window) for out, col in totals.items()})


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Most frequent non-null value of each group, smallest value on a tie."""
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("occurrences")))
    return (top1(counts, keys, [F.col("occurrences").desc(), F.col(value).asc()])
            .select(*keys, F.col(value).alias(out), "occurrences"))


def global_rank(df: DataFrame, order: Order, out: str = "rank") -> DataFrame:
    """Numbers all rows 1..n in the given order, without a task that sees them all.

    Rows are dealt by range and sorted within their range; each range is written once with the
    place of every row in it, and the sizes of the ranges, one row each, give where it starts. Rows
    equal in the order are numbered one after another in no stated order, and may be dealt to
    several tasks. Name further columns in ``order`` where their order matters. Nulls go where the
    order puts them. The result is a stored table, so a number never changes between reads.
    """
    spark = df.sparkSession
    keys = [_col(o) for o in order]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())  # equal rows need not share a range
    placed = (tied.repartitionByRange(*keys, F.col("_tie")).sortWithinPartitions(*keys, F.col("_tie"))
              .withColumn("_tie", F.monotonically_increasing_id()))
    path = scratch_dir(spark, "ranked")
    placed.write.parquet(path)
    kept = spark.read.schema(placed.schema).parquet(path)
    kept = kept.withColumn("_range", F.shiftright("_tie", 33))  # the number of the task; the rest counts its rows
    sizes = kept.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_tie") - F.shiftleft(F.col("_range"), 33)
    return (kept.join(starts, "_range").withColumn(out, F.col("_before") + inside + 1)
            .drop("_range", "_tie", "_before"))
