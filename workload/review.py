"""Review queues and player pages, for all players at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.plans import review
from workload.models import Models
from workload.registry import query
from workload.sql import mean, percent, rnd, with_ctes
from workload.tables import Tables

_COUNTS = ("winners", "unforced_errors", "first_serves_in", "first_serves_total", "break_points_won", "break_points_total")
_REVIEWED = """
    SELECT CASE WHEN toxic = 0 THEN concat('m', doc_id) END AS session_id FROM labels
    UNION ALL SELECT concat('t', doc_id) FROM labels"""
_QUEUE = f"""
    SELECT *, CASE WHEN extraction_confidence < 0.6 THEN 'low' WHEN extraction_confidence < 0.8 THEN 'medium'
                   ELSE 'high' END AS confidence_band
    FROM (SELECT match_id AS session_id, player_id, match_date AS session_date, session_time,
                 'match' AS session_type, {', '.join(_COUNTS)}, raw_note_text, extraction_confidence, source_file
          FROM raw_match
          UNION ALL
          SELECT session_id, player_id, session_date, session_time, 'training',
                 {', '.join('NULL' for _ in _COUNTS)}, raw_note_text, extraction_confidence, source_file
          FROM raw_training)
    WHERE extraction_confidence < 0.8
      AND session_id NOT IN (SELECT session_id FROM ({_REVIEWED}) WHERE session_id IS NOT NULL)"""


def _reviewed(t: Tables) -> DataFrame:
    """Approved sessions; some ids are unknown, which must not hide the whole queue."""
    return t.labels.select(F.when(F.col("toxic") == 0, F.concat(F.lit("m"), "doc_id")).alias("session_id")).unionByName(
        t.labels.select(F.concat(F.lit("t"), "doc_id").alias("session_id")))


@query(with_ctes(_QUEUE, "raw_match", "raw_training"))
def review_queue(t: Tables) -> DataFrame:
    return review.review_queue(t.raw_matches, t.raw_training, _reviewed(t))


@query(with_ctes(f"""
    SELECT session_id, session_type, extraction_confidence,
           row_number() OVER (ORDER BY extraction_confidence NULLS FIRST, session_id) AS position FROM ({_QUEUE})""",
    "raw_match", "raw_training"))
def ranked_review_queue(t: Tables) -> DataFrame:
    """The queue's order as a column: ranges sorted by themselves, no task that holds all of it."""
    queue = review.review_queue(t.raw_matches, t.raw_training, _reviewed(t))
    return review.ranked_queue(queue.select("session_id", "session_type", "extraction_confidence"))


@query(with_ctes(f"""
    SELECT (SELECT count(*) FROM ({_QUEUE}) WHERE session_type = 'match') AS pending_reviews,
           (SELECT count(*) FROM ({_REVIEWED})) AS eval_set_size""", "raw_match", "raw_training"))
def review_counts(t: Tables) -> DataFrame:
    queue = review.review_queue(t.raw_matches, t.raw_training, _reviewed(t), kind="match")
    return review.review_counts(queue, _reviewed(t))


def _findings(t: Tables) -> DataFrame:
    """Orders read as findings: priority is the severity, the order status the coach's decision."""
    return t.orders.selectExpr(
        "o_orderkey AS finding_id", "o_custkey AS session_id", "o_orderdate AS audited_at",
        f"{_SEVERITY} AS severity", f"{_STATUS} AS coach_status")


_SEVERITY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'medium' ELSE 'low' END"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'P' THEN 'dismissed' ELSE 'pending' END"
_FINDINGS = f"""
    SELECT o_orderkey AS finding_id, o_custkey AS session_id, o_orderdate AS audited_at,
           {_SEVERITY} AS severity, {_STATUS} AS coach_status FROM orders"""


@query(f"SELECT * FROM ({_FINDINGS}) WHERE coach_status = 'pending'")
def findings_view(t: Tables) -> DataFrame:
    return review.findings_view(_findings(t))


@query(f"SELECT * FROM ({_FINDINGS}) WHERE severity = 'high'")
def findings_view_high(t: Tables) -> DataFrame:
    return review.findings_view(_findings(t), status="All", severity="high")


@query(f"""
    SELECT count(*) AS total_findings, count(*) FILTER (severity = 'high') AS high_severity,
           count(*) FILTER (coach_status = 'pending') AS pending_review,
           count(*) FILTER (coach_status = 'confirmed') AS confirmed_issues
    FROM ({_FINDINGS})""")
def finding_kpis(t: Tables) -> DataFrame:
    return review.finding_kpis(_findings(t))


@query(with_ctes("SELECT DISTINCT player_id FROM fct_match", "fct_match"))
def player_list(t: Tables) -> DataFrame:
    return review.player_list(Models(t).fct_match)


def _dashboard(t: Tables) -> review.Dashboard:
    m = Models(t)
    return review.player_dashboard(m.fct_match, m.fct_training, m.digest)


_BY_MATCH = "PARTITION BY player_id ORDER BY match_date DESC, session_time DESC, match_id DESC"
_BY_DAY = "PARTITION BY player_id ORDER BY session_date DESC"
_BY_WEEK = "PARTITION BY player_id ORDER BY week_start DESC"


@query(with_ctes(f"""
    SELECT player_id, CAST(row_number() OVER ({_BY_MATCH}) AS INTEGER) AS recency, match_id, match_date, score,
           CASE WHEN player_won THEN 'Win' WHEN NOT player_won THEN 'Loss' ELSE '-' END AS result,
           {percent('first_serve_pct')} AS first_serve_label, {percent('break_point_conversion')} AS break_point_label,
           second_serve_pct, return_points_won_pct, rallies_9plus_won_pct, winners, unforced_errors, has_note,
           extraction_confidence
    FROM fct_match QUALIFY recency <= 20""", "fct_match"))
def dashboard_matches(t: Tables) -> DataFrame:
    return _dashboard(t).matches


@query(with_ctes(f"""
    SELECT player_id, CAST(row_number() OVER ({_BY_DAY}) AS INTEGER) AS recency, session_date, sessions_on_day,
           {percent('avg_shots_in')} AS shots_in_label, {percent('avg_forehand_cross_court_in')} AS forehand_label,
           {percent('avg_backhand_cross_court_in')} AS backhand_label, avg_serve_speed_ad, avg_serve_speed_deuce,
           max_longest_rally, avg_rallies_above_5_shots
    FROM fct_training QUALIFY recency <= 10""", "fct_training"))
def dashboard_training(t: Tables) -> DataFrame:
    return _dashboard(t).training


@query(with_ctes(f"""
    SELECT *, CAST(row_number() OVER ({_BY_WEEK}) AS INTEGER) AS recency FROM digest QUALIFY recency <= 12""", "digest"))
def dashboard_scores(t: Tables) -> DataFrame:
    return _dashboard(t).scores


@query(with_ctes(f"""
    SELECT player_id, CAST(row_number() OVER ({_BY_MATCH}) AS INTEGER) AS recency, match_id, match_date, raw_note_text
    FROM fct_match WHERE has_note QUALIFY recency <= 5""", "fct_match"))
def dashboard_notes(t: Tables) -> DataFrame:
    return _dashboard(t).notes


@query(with_ctes(f"""
    SELECT player_id, week_start, {rnd('development_score', 1)} AS development_score,
           coalesce(CAST({rnd('score_change', 1)} AS VARCHAR), score_trend) AS delta,
           CASE score_trend WHEN 'improving' THEN 'up' WHEN 'declining' THEN 'down' ELSE 'flat' END AS direction,
           matches_played, sessions_completed
    FROM digest QUALIFY row_number() OVER ({_BY_WEEK}) = 1""", "digest"))
def dashboard_headline(t: Tables) -> DataFrame:
    return _dashboard(t).headline


@query(with_ctes(f"""
    SELECT player_id, count(*) FILTER (player_won) AS wins, count(*) AS matches,
           {rnd('count(*) FILTER (player_won) / count(*)', 4)} AS win_rate
    FROM (SELECT * FROM fct_match QUALIFY row_number() OVER ({_BY_MATCH}) <= 20) GROUP BY 1""", "fct_match"))
def dashboard_win_rate(t: Tables) -> DataFrame:
    return _dashboard(t).win_rate


def _whole(x: str) -> str:
    return f"coalesce(CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR), 'N/A')"


@query(with_ctes(f"""
    SELECT player_id, coalesce(match_summary, '') AS match_summary, coalesce(training_summary, '') AS training_summary,
           coalesce(notes_summary, '') AS notes_summary
    FROM (SELECT player_id, 'Last 3 matches: ' || count(*) FILTER (player_won) || ' wins, '
                 || (3 - count(*) FILTER (player_won)) || ' losses. Avg first serve: '
                 || {_whole(f"{mean('first_serve_pct', 6)} * 100")} || '%. Avg winners: ' || {_whole('avg(winners)')}
                 || '. Avg unforced errors: ' || {_whole('avg(unforced_errors)')} || '.' AS match_summary
          FROM (SELECT * FROM fct_match QUALIFY row_number() OVER ({_BY_MATCH}) <= 3) GROUP BY 1)
    FULL JOIN (SELECT player_id, 'Last 2 sessions: avg shot accuracy ' || {_whole(f"{mean('avg_shots_in', 6)} * 100")}
                 || '%. Forehand cross-court: ' || {_whole(f"{mean('avg_forehand_cross_court_in', 6)} * 100")}
                 || '%. Backhand cross-court: ' || {_whole(f"{mean('avg_backhand_cross_court_in', 6)} * 100")}
                 || '%.' AS training_summary
          FROM (SELECT * FROM fct_training QUALIFY row_number() OVER ({_BY_DAY}) <= 2) GROUP BY 1) USING (player_id)
    FULL JOIN (SELECT player_id, 'Recent coaching notes: '
                 || string_agg(raw_note_text, ' | ' ORDER BY match_date DESC, session_time DESC, match_id DESC) AS notes_summary
          FROM (SELECT * FROM fct_match WHERE has_note QUALIFY row_number() OVER ({_BY_MATCH}) <= 2) GROUP BY 1)
    USING (player_id)""", "fct_match", "fct_training"))
def recommendation_context(t: Tables) -> DataFrame:
    m = Models(t)
    return review.recommendation_context(m.fct_match, m.fct_training)
