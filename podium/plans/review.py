"""Human review: extraction queue, findings queue, player pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.aggregates import count_where, mean_rounded
from podium.functions.predicates import below_confidence, maybe_eq
from podium.functions.scalars import confidence_band, map_values, percent_label, rank_of, typed_null
from podium.operators.joins import not_reviewed
from podium.operators.summaries import recent_win_rate
from podium.operators.windows import global_rank, latest
from podium.plans.audit import SEVERITIES

# Figures and labels the review pages show.
_COUNTS = ("winners", "unforced_errors", "first_serves_in", "first_serves_total",
           "break_points_won", "break_points_total")
RESULT_LABELS = {True: "Win", False: "Loss"}
TREND_LABELS = {"improving": "up", "declining": "down"}


def review_queue(matches: DataFrame, training: DataFrame, reviewed: DataFrame,
                 threshold: float = 0.8, kind: str = "All") -> DataFrame:
    """Extractions below the threshold that nobody approved yet, least confident first."""
    shared = ("player_id", "session_date", "session_time")
    tail = ("raw_note_text", "extraction_confidence", "source_file")
    played = matches.filter(below_confidence(threshold)).select(
        F.col("match_id").alias("session_id"), "player_id", F.col("match_date").alias("session_date"),
        "session_time", F.lit("match").alias("session_type"), *_COUNTS, *tail)
    trained = training.filter(below_confidence(threshold)).select(
        "session_id", *shared, F.lit("training").alias("session_type"),
        *[typed_null("bigint").alias(c) for c in _COUNTS], *tail)
    queue = maybe_eq(played.unionByName(trained), "session_type", kind)
    return (not_reviewed(queue, reviewed)
            .withColumn("confidence_band", confidence_band("extraction_confidence"))
            .orderBy("extraction_confidence", "session_id"))


def review_counts(queue: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Pending and approved totals, in one row."""
    pending = queue.agg(F.count(F.lit(1)).alias("pending_reviews"))
    return pending.withColumn("eval_set_size", reviewed.agg(F.count(F.lit(1))).scalar())


def findings_view(findings: DataFrame, status: str = "pending", severity: str = "All") -> DataFrame:
    """Findings for the chosen status and severity, most severe and most recent first."""
    chosen = maybe_eq(maybe_eq(findings, "coach_status", status), "severity", severity)
    return order_by_rank(chosen, "severity", SEVERITIES[:2], F.col("audited_at").desc(), F.col("finding_id"))


def order_by_rank(df: DataFrame, col: str, ranks: tuple[str, ...], *then: Column) -> DataFrame:
    return df.orderBy(rank_of(col, ranks), *then)


def ranked_by(df: DataFrame, col: str, ranks: tuple[str, ...], *then: Column, out: str = "position") -> DataFrame:
    """The order of :func:`order_by_rank` as a column, for readers that page through a stored table."""
    return global_rank(df, [rank_of(col, ranks), *then], out)


def ranked_queue(queue: DataFrame, out: str = "position") -> DataFrame:
    """Place of every extraction in the review queue: least confident first, unknown confidence before all."""
    return global_rank(queue, [F.col("extraction_confidence").asc_nulls_first(), F.col("session_id").asc_nulls_first()], out)


def finding_kpis(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.count(F.lit(1)).alias("total_findings"),
        count_where(F.col("severity") == "high").alias("high_severity"),
        count_where(F.col("coach_status") == "pending").alias("pending_review"),
        count_where(F.col("coach_status") == "confirmed").alias("confirmed_issues"))


@dataclass(frozen=True)
class Dashboard:
    matches: DataFrame
    training: DataFrame
    scores: DataFrame
    notes: DataFrame
    headline: DataFrame
    win_rate: DataFrame


def player_list(matches: DataFrame) -> DataFrame:
    return matches.select("player_id").distinct().orderBy("player_id")


def player_dashboard(matches: DataFrame, training: DataFrame, digest: DataFrame, player: str = "All",
                     n: Sequence[int] = (20, 10, 12, 5)) -> Dashboard:
    """Recent rows of one player, or of every player at once.

    Choosing a player filters before the ranking, so partitions and files of others are skipped.
    """
    by_match = [F.col("match_date").desc(), F.col("session_time").desc(), F.col("match_id").desc()]
    matches, training, digest = (maybe_eq(df, "player_id", player) for df in (matches, training, digest))
    recent = latest(matches, ["player_id"], by_match, n[0], "recency")
    scores = latest(digest, ["player_id"], [F.col("week_start").desc()], n[2], "recency")
    return Dashboard(
        matches=recent.select(
            "player_id", "recency", "match_id", "match_date", "score",
            map_values("player_won", RESULT_LABELS, "-").alias("result"),
            percent_label("first_serve_pct").alias("first_serve_label"),
            percent_label("break_point_conversion").alias("break_point_label"),
            "second_serve_pct", "return_points_won_pct", "rallies_9plus_won_pct",
            "winners", "unforced_errors", "has_note", "extraction_confidence"),
        training=latest(training, ["player_id"], [F.col("session_date").desc()], n[1], "recency").select(
            "player_id", "recency", "session_date", "sessions_on_day",
            percent_label("avg_shots_in").alias("shots_in_label"),
            percent_label("avg_forehand_cross_court_in").alias("forehand_label"),
            percent_label("avg_backhand_cross_court_in").alias("backhand_label"),
            "avg_serve_speed_ad", "avg_serve_speed_deuce", "max_longest_rally",
            "avg_rallies_above_5_shots"),
        scores=scores,
        notes=latest(matches.filter(F.col("has_note")), ["player_id"], by_match, n[3], "recency").select(
            "player_id", "recency", "match_id", "match_date", "raw_note_text"),
        headline=scores.filter(F.col("recency") == 1).select(
            "player_id", "week_start", F.round("development_score", 1).alias("development_score"),
            F.coalesce(F.round("score_change", 1).cast("string"), "score_trend").alias("delta"),
            map_values("score_trend", TREND_LABELS, "flat").alias("direction"),
            "matches_played", "sessions_completed"),
        win_rate=recent_win_rate(matches, "player_id", by_match, "player_won", n[0]))


def recommendation_context(matches: DataFrame, training: DataFrame) -> DataFrame:
    """Text on recent form per player: last three matches, last two sessions, last two notes.

    The three inputs are cut to a few rows per player before anything is put together.
    """
    by_match = [F.col("match_date").desc(), F.col("session_time").desc(), F.col("match_id").desc()]
    recent = latest(matches, ["player_id"], by_match, 3)
    wins = F.count_if("player_won")
    match_text = recent.groupBy("player_id").agg(
        F.concat(
            F.lit("Last 3 matches: "), wins.cast("string"), F.lit(" wins, "), (3 - wins).cast("string"),
            F.lit(" losses. Avg first serve: "), _whole(mean_rounded("first_serve_pct", 6) * 100),
            F.lit("%. Avg winners: "), _whole(F.avg("winners")),
            F.lit(". Avg unforced errors: "), _whole(F.avg("unforced_errors")), F.lit(".")).alias("match_summary"))
    sessions = latest(training, ["player_id"], [F.col("session_date").desc()], 2)
    training_text = sessions.groupBy("player_id").agg(
        F.concat(
            F.lit("Last 2 sessions: avg shot accuracy "), _whole(mean_rounded("avg_shots_in", 6) * 100),
            F.lit("%. Forehand cross-court: "), _whole(mean_rounded("avg_forehand_cross_court_in", 6) * 100),
            F.lit("%. Backhand cross-court: "), _whole(mean_rounded("avg_backhand_cross_court_in", 6) * 100),
            F.lit("%.")).alias("training_summary"))
    notes = latest(matches.filter(F.col("raw_note_text").isNotNull()), ["player_id"], by_match, 2, "recency")
    note_text = notes.groupBy("player_id").agg(
        F.concat(F.lit("Recent coaching notes: "), F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("recency", "raw_note_text"))),
                        lambda n: n["raw_note_text"]), " | ")).alias("notes_summary"))
    return (match_text.join(training_text, "player_id", "full").join(note_text, "player_id", "full")
            .fillna("", ["match_summary", "training_summary", "notes_summary"]))


def _whole(value: Column) -> Column:
    """Whole number as text, halves to even, ``N/A`` when there is nothing to average."""
    return F.coalesce(F.bround(value).cast("bigint").cast("string"), F.lit("N/A"))
