"""Gold: dimension, facts, weekly score, weekly digest, monthly report.

The score combines its inputs by stacking them and grouping once on the output grain. That gives the
rows of a full outer join with one shuffle of partly aggregated rows instead of one per input and a
sorted join, and a busy player is reduced in the map tasks. The report groups each input for itself, in
the map tasks first as well, and joins the groups to those of the matches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.aggregates import count_where, mean_rounded, ratio_of, spread
from podium.functions.scalars import (
    capped, classify_trend, fill_defaults, month_start, rescale, surrogate_key, week_start, weighted_score, year_month,
)
from podium.operators.changes import newer_than
from podium.operators.joins import lookup_sk
from podium.operators.windows import mode_per_group, rolling_days, with_change

# Component weights of the development score.
SCORE_WEIGHTS = {
    "win_rate": Decimal("0.40"),
    "opponent_strength": Decimal("0.30"),
    "technique": Decimal("0.20"),
    "break_point": Decimal("0.10"),
}
# Value of a component a player-week has no rows for.
SCORE_DEFAULTS = {
    "weighted_win_rate": 0.0, "avg_opponent_strength": 1.0, "avg_break_point_conversion": 0.0,
    "matches_played": 0, "matches_won": 0, "avg_technique_score": 0.0,
    "sessions_completed": 0, "avg_shots_per_hour": 0.0,
}
# Columns of the dimension.
_DIM_COLUMNS = (
    "preferred_name", "full_name", "chinese_name", "date_of_birth", "utr_rating", "age_group",
    "dominant_hand", "competition_level", "goals", "coach_id", "contact_email", "submitted_at",
    "valid_from", "valid_to", "is_current",
)


def dim_player(students: DataFrame) -> DataFrame:
    """One row per student version."""
    return students.select(
        surrogate_key("student_id", "valid_from").alias("player_sk"),
        F.col("student_id").alias("player_id"), *_DIM_COLUMNS)


def fct_match(matches: DataFrame, dim: DataFrame, dim_key: str = "player_id") -> DataFrame:
    return (lookup_sk(matches, dim, dim_key=dim_key)
            .withColumn("match_sk", surrogate_key("match_id"))
            .withColumn("has_note", F.col("raw_note_text").isNotNull()))


def fct_training(rollup: DataFrame, dim: DataFrame, dim_key: str = "player_id") -> DataFrame:
    return (lookup_sk(rollup, dim, dim_key=dim_key)
            .withColumn("session_sk", surrogate_key("player_id", "session_date")))


def with_note_sentiment(facts: DataFrame, notes: DataFrame, event_type: str, key: str) -> DataFrame:
    """Sentiment of the staged note observation on each fact, null without one."""
    observed = notes.filter(F.col("event_type") == event_type).select(
        F.col("event_id").alias(key), F.col("sentiment").alias("note_sentiment"))
    return facts.join(observed, key, "left")


def development_score(matches: DataFrame, training: DataFrame,
                      weights: Mapping[str, Decimal] = SCORE_WEIGHTS) -> DataFrame:
    """Composite 0-100 score per player and week."""
    played = matches.select(
        "player_id", "player_sk", week_start("match_date").alias("score_week"),
        F.lit(1).alias("match"), "weighted_win", "opponent_strength_weight",
        "break_point_conversion", "player_won")
    trained = training.select(
        "player_id", "player_sk", week_start("session_date").alias("score_week"),
        F.lit(1).alias("session"),
        ((F.coalesce("avg_forehand_cross_court_in", F.lit(0.0))
          + F.coalesce("avg_backhand_cross_court_in", F.lit(0.0))) / 2).alias("technique"),
        "total_shots_per_hour")
    weekly = (played.unionByName(trained, allowMissingColumns=True)
              .groupBy("player_id", "score_week")
              .agg(F.min("player_sk").alias("player_sk"),
                   mean_rounded("weighted_win", 4).alias("weighted_win_rate"),
                   mean_rounded("opponent_strength_weight", 4).alias("avg_opponent_strength"),
                   mean_rounded("technique", 4).alias("avg_technique_score"),
                   mean_rounded("break_point_conversion", 4).alias("avg_break_point_conversion"),
                   F.count("match").alias("matches_played"),
                   count_where(F.col("player_won")).alias("matches_won"),
                   F.count("session").alias("sessions_completed"),
                   mean_rounded("total_shots_per_hour", 1).alias("avg_shots_per_hour")))
    return score_weeks(fill_defaults(weekly, SCORE_DEFAULTS), weights)


def score_weeks(weekly: DataFrame, weights: Mapping[str, Decimal] = SCORE_WEIGHTS) -> DataFrame:
    """Normalised components and their weighted sum, for rows without nulls.

    The two match-strength components are worked out in decimals, so that a component that ends on
    a half is rounded up and not by the last bit of a double.
    """
    rate = F.col("weighted_win_rate").cast("decimal(16,4)")
    strength = F.col("avg_opponent_strength").cast("decimal(6,4)")
    parts: dict[str, Column] = {
        "win_rate": capped(rate, 50),
        "opponent_strength": rescale(strength, Decimal("0.5"), Decimal("2.0")),
        "technique": capped("avg_technique_score", 100),
        "break_point": capped("avg_break_point_conversion", 100),
    }
    scored = weekly.withColumns(parts).withColumn("development_score", weighted_score(weights).cast("double"))
    return (scored
            .withColumns({f"{name}_score": F.round(name, 2).cast("double") for name in parts})
            .drop(*parts))


def weekly_digest(scores: DataFrame, target: DataFrame | None = None, look_back_weeks: int = 0) -> DataFrame:
    """Score trend per player and week; with ``target`` only the weeks it does not cover yet.

    The change is taken over the whole history before the filter, so an increment equals the same
    weeks of a full build. ``look_back_weeks`` emits that many covered weeks again, for late rows.
    """
    digest = with_change(
        scores.select("player_id", "player_sk", F.col("score_week").alias("week_start"),
                      "development_score", "matches_played", "matches_won",
                      "sessions_completed", "avg_shots_per_hour"),
        ["player_id"], ["week_start"], "development_score", "prior_week_score", "score_change")
    digest = digest.withColumns({
        "score_trend": classify_trend("score_change"),
        "digest_id": surrogate_key("player_id", "week_start"),
    })
    return newer_than(digest, "week_start", target, "week_start",
                      F.date_sub("_high", 7 * look_back_weeks) if look_back_weeks else None)


def monthly_report(matches: DataFrame, training: DataFrame, scores: DataFrame,
                   target: DataFrame | None = None, look_back_months: int = 0) -> DataFrame:
    """One row per player and month with a match; with ``target`` only months it does not cover.

    Months of training alone do not appear. The high-water filter is applied to every input
    before the grouping. The inputs are grouped apart, as hardly two weeks of one player share a row of partial sums
    with a match: stacked, every one of them would carry the sums of all three.
    """
    earlier = F.date_format(F.add_months(F.to_date("_high", "yyyy-MM"), -look_back_months), "yyyy-MM")

    def recent(df: DataFrame) -> DataFrame:
        return newer_than(df, "report_month", target, "report_month", earlier if look_back_months else None)

    def by_month(df: DataFrame, date: str, *measures: Column | str) -> DataFrame:
        rows = df.select("player_id", F.to_date(F.col(date)).alias("_day"), *measures)
        if target is not None:
            rows = recent(rows.withColumn("report_month", year_month("_day")))
        # A struct joins on its nulls, too, and a day is shorter than the name of a month.
        return rows.groupBy(F.struct("player_id", month_start("_day").alias("month")).alias("_at"))

    matches_played, matches_won = F.count(F.lit(1)), count_where(F.col("player_won"))
    played = by_month(matches, "match_date", "player_won", "first_serve_pct", "break_point_conversion").agg(
        matches_played.alias("matches_played"),
        matches_won.alias("matches_won"),
        ratio_of(matches_won, matches_played).alias("win_rate"),
        mean_rounded("first_serve_pct", 4).alias("avg_first_serve_pct"),
        mean_rounded("break_point_conversion", 4).alias("avg_break_point_conversion"))
    trained = by_month(training, "session_date", "total_shots_per_hour").agg(
        F.count(F.lit(1)).alias("sessions_completed"),
        mean_rounded("total_shots_per_hour", 1).alias("avg_shots_per_hour"))
    scored = by_month(scores, "score_week", "development_score").agg(
        mean_rounded("development_score", 2).alias("development_score"),
        spread("development_score", 2).alias("score_range"))
    monthly = played.join(trained.hint("merge"), "_at", "left").join(scored.hint("merge"), "_at", "left")
    report = monthly.select(
        "_at.player_id", year_month("_at.month").alias("report_month"), "matches_played", "matches_won", "win_rate", "avg_first_serve_pct",
        "avg_break_point_conversion", F.coalesce("sessions_completed", F.lit(0)).cast("bigint").alias("sessions_completed"),
        "avg_shots_per_hour", "development_score", "score_range")
    return report.withColumn("report_id", surrogate_key("player_id", "report_month"))


def score_vs_last_month(report: DataFrame) -> DataFrame:
    """Change of the monthly score against the player's previous reported month."""
    changed = with_change(report, ["player_id"], ["report_month"], "development_score",
                          "prior_month_score", "score_vs_last_month")
    return changed.withColumn("score_vs_last_month", F.round("score_vs_last_month", 2))


def rolling_win_rate(matches: DataFrame, days: int = 30) -> DataFrame:
    """Win rate over the last ``days`` calendar days, per player and match day."""
    daily = matches.groupBy("player_id", "match_date").agg(
        F.count(F.lit(1)).alias("day_matches"), count_where(F.col("player_won")).alias("day_wins"))
    rolled = rolling_days(daily, ["player_id"], "match_date", days,
                          {"matches_in_window": "day_matches", "wins_in_window": "day_wins"})
    return rolled.withColumn(
        "rolling_win_rate",
        F.round(F.col("wins_in_window").cast("double") / F.col("matches_in_window"), 4))


def top_issue(notes: DataFrame, keys: Sequence[str] = ("player_id", "week_start")) -> DataFrame:
    """Most common issue noted per player and week."""
    weekly = notes.withColumn("week_start", week_start("event_date"))
    return mode_per_group(weekly, list(keys), "issue", "top_issue")
