"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.aggregates import count_where, mean_rounded, ratio_of
from podium.operators.joins import lookup
from podium.operators.windows import latest


def value_counts(df: DataFrame, cols: Sequence[str], by_count: bool = True) -> DataFrame:
    """Frequency table, most frequent first or in key order."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.col("rows").desc(), *cols) if by_count else counts.orderBy(*cols)


def profile(df: DataFrame, key: str, day: str, players: str) -> DataFrame:
    """One row: volume, distinct keys and players, date range."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("unique_keys"),
        F.count_distinct(players).alias("unique_players"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def mean_confidence(df: DataFrame, col: str = "extraction_confidence") -> DataFrame:
    return df.agg(mean_rounded(col, 4).alias("avg_confidence"))


def group_pages(pages: DataFrame, session: Sequence[str], page: str, path: str,
                chunk: int = 50) -> DataFrame:
    """Sorted page paths of each session, in one row as long as the session has few pages.

    A longer session becomes several rows instead of one list that a single task would have to
    hold: ``part`` numbers its stretches of ``chunk`` page numbers, and a stretch that still has
    more than ``chunk`` pages (many copies of one page) is shared out by path into ``share``.
    """
    placed = pages.withColumn("part", F.floor((F.col(page) - 1) / chunk))
    stretch = ["session_id", "part"]
    crowded = (placed.groupBy(*stretch).agg(F.count(F.lit(1)).alias("_pages"))
               .filter(F.col("_pages") > chunk)
               .select(*stretch, F.ceil(F.col("_pages") / chunk).alias("_shares")))
    shared = lookup(placed, crowded, stretch).withColumn(
        "share", F.coalesce(F.pmod(F.xxhash64(path), "_shares"), F.lit(0).cast("bigint")))
    return (shared.groupBy(*session, "part", "share")
            .agg(F.sort_array(F.collect_list(path)).alias("file_paths"),
                 F.count(F.lit(1)).alias("page_count")))


def recent_win_rate(df: DataFrame, player: str, order: Sequence, won: str, n: int = 20) -> DataFrame:
    """Wins over the last ``n`` matches of every player."""
    recent = latest(df, [player], order, n)
    return (recent.groupBy(player)
            .agg(count_where(F.col(won)).alias("wins"), F.count(F.lit(1)).alias("matches"))
            .withColumn("win_rate", F.round(F.col("wins").cast("double") / F.col("matches"), 4)))


def match_accuracy(joined: DataFrame, expected: str, found: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose two fields agree; 0 when there are no rows."""
    correct = count_where(F.col(expected) == F.col(found))
    total = F.count(F.lit(1))
    return joined.groupBy(*by).agg(
        total.alias("total"), correct.alias("correct"),
        F.coalesce(ratio_of(correct, total), F.lit(0.0)).alias("accuracy"))
