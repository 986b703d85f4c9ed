"""Silver intermediate: match strength, daily rollup, training-to-match linkage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.aggregates import mean_rounded
from podium.functions.scalars import opponent_strength, win_value, with_calendar
from podium.operators.joins import nearest_following
from podium.schemas import TRAINING_ACCURACIES, TRAINING_SPEEDS

_MATCH_COLUMNS = (
    "match_id", "player_id", "match_date", "session_time", "score", "player_won",
    "winners", "unforced_errors", "forehand_winners", "backhand_winners",
    "total_points_won_pct", "break_point_conversion", "break_points_saved_pct",
    "first_serve_pct", "second_serve_pct", "first_serves_won_pct", "second_serves_won_pct",
    "return_points_won_pct", "rallies_1_4_won_pct", "rallies_5_8_won_pct",
    "rallies_9plus_won_pct", "raw_note_text", "extraction_confidence",
)
# What the linkage carries over from each side.
_LINK_TRAINING = ("player_id", "session_date", "avg_shots_in", "avg_forehand_cross_court_in",
                  "avg_backhand_cross_court_in", "sessions_on_day")
_LINK_MATCH = ("player_id", "match_id", "match_date", "player_won", "weighted_win",
               "opponent_strength_weight", "total_points_won_pct", "break_point_conversion",
               "first_serve_pct", "raw_note_text")


def match_strength(matches: DataFrame, rated: bool = False) -> DataFrame:
    """Strength weight, weighted win and calendar keys of every match.

    The weight is neutral unless ``rated``, which takes it from the opponent's rating.
    """
    weight: Column = opponent_strength("opponent_utr") if rated else F.lit(1.0)
    weighted = (matches
                .select(*_MATCH_COLUMNS, weight.alias("opponent_strength_weight"))
                .withColumn("weighted_win", win_value("player_won", F.col("opponent_strength_weight"))))
    return with_calendar(weighted, "match_date", "match")


def daily_rollup(training: DataFrame) -> DataFrame:
    """One row per player and day."""
    rolled = training.groupBy("player_id", "session_date").agg(
        F.count(F.lit(1)).alias("sessions_on_day"),
        F.sum("shots_per_hour").alias("total_shots_per_hour"),
        F.max("longest_rally").alias("max_longest_rally"),
        *[mean_rounded(col, 4).alias(out) for col, out in TRAINING_ACCURACIES.items()],
        *[mean_rounded(col, 1).alias(out) for col, out in TRAINING_SPEEDS.items()],
        mean_rounded("extraction_confidence", 4).alias("avg_extraction_confidence"),
    )
    return with_calendar(rolled, "session_date", "session")


def link_to_match(rollup: DataFrame, matches: DataFrame, days: int = 7) -> DataFrame:
    """Each training day with the player's closest match within ``days``, or none.

    Two matches on one day are told apart by their time, then their id. The note shown is the
    match's own.
    """
    linked = nearest_following(
        rollup.select(*_LINK_TRAINING).withColumnRenamed("session_date", "training_date"),
        matches.select(*_LINK_MATCH, "session_time"),
        key="player_id", left_day="training_date", right_day="match_date", days=days,
        tie_break=["session_time", "match_id"], distance="days_to_match")
    return linked.drop("session_time").withColumns({
        "has_linked_match": F.col("days_to_match").isNotNull(), "match_rank": F.lit(1)})
