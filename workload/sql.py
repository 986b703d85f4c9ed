"""The oracle's SQL: the models written out as common table expressions for DuckDB.

The oracle follows the definitions of the models, not the code: joins where the code stacks and
groups, decimal sums where the code counts in whole units, sub-selects where it uses windows.
"""

from __future__ import annotations

from podium.schemas import MATCH_RATIOS, RAW_MATCHES, RAW_TRAINING, TRAINING_ACCURACIES, TRAINING_SPEEDS
from workload.tables import MATCH_EXPR, STUDENT_EXPR, TRAINING_EXPR

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTE[name] = (needs, sql)


def with_ctes(sql: str, *names: str) -> str:
    """``sql`` preceded by the named expressions and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in CTE[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in ordered) + "\n" + sql


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def mean(x: str, digits: int) -> str:
    """Rounded mean of the whole values, from the sum of their decimal texts."""
    return rnd(f"CAST(sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18))) AS DOUBLE) / count({x})", digits)


def ratio(num: str, den: str, digits: int = 4) -> str:
    return f"CASE WHEN {den} > 0 THEN {rnd(f'CAST({num} AS DOUBLE) / {den}', digits)} END"


def n(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def key(*cols: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_null_')" for c in cols) + "))"


def sha(*cols: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_null_')" for c in cols) + "))"


def week(d: str) -> str:
    return f"CAST(date_trunc('week', {d}) AS DATE)"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def ym(d: str) -> str:
    return f"strftime({d}, '%Y-%m')"


def percent(x: str) -> str:
    return f"coalesce(CAST({rnd(f'{x} * 100', 1)} AS VARCHAR) || '%', 'N/A')"


_DUCK = {"STRING": "VARCHAR", "BIGINT": "BIGINT", "INT": "INTEGER", "DOUBLE": "DOUBLE",
         "DATE": "DATE", "BOOLEAN": "BOOLEAN", "TIMESTAMP": "TIMESTAMP"}


def _typed(schema, formulas) -> str:
    """Every declared column, from its formula or as a typed null."""
    out = []
    for f in schema:
        kind = _DUCK[f.dataType.simpleString().upper()]
        out.append(f"CAST({formulas.get(f.name, 'NULL')} AS {kind}) AS {f.name}")
    return ", ".join(out)


cte("ev", (), """
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(floor(value) AS BIGINT) AS v
    FROM events""")
cte("raw_match", ("ev",), f"""
    SELECT {_typed(RAW_MATCHES, {**MATCH_EXPR, 'session_time': "strftime(ts, '%H%M')"})}
    FROM ev WHERE event_type IN ('purchase', 'error')""")
cte("raw_training", ("ev",), f"""
    SELECT {_typed(RAW_TRAINING, {**TRAINING_EXPR, 'session_time': "strftime(ts, '%H%M')"})}
    FROM ev WHERE event_type IN ('view', 'click')""")
cte("raw_student", (), f"""
    SELECT {', '.join(f'{text} AS {name}' for name, text in STUDENT_EXPR.items())} FROM customer""")
cte("seed", (), """
    SELECT ' P' || c_custkey || '  ' AS alias, ' Player-' || c_custkey AS canonical_player_id,
           c_mktsegment AS alias_source
    FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
cte("stg_alias", ("seed",), """
    SELECT trim(lower(alias)) AS alias, trim(lower(canonical_player_id)) AS canonical_player_id,
           trim(alias_source) AS alias_source
    FROM seed""")

MATCH_STAGED = [c for c in RAW_MATCHES.names if c not in (
    "tournament_name", "surface", "pages_processed", "source_file", "serve_points_won", "serve_points_total")]
TRAINING_STAGED = [c for c in RAW_TRAINING.names if c not in ("pages_processed", "source_file")]

cte("stg_match", ("raw_match", "stg_alias"), f"""
    SELECT coalesce(a.canonical_player_id, trim(lower(r.player_id))) AS player_id,
           {', '.join(f'r.{c}' for c in MATCH_STAGED if c != 'player_id')},
           {', '.join(f'{ratio(f"r.{num}", f"r.{den}")} AS {out}' for out, (num, den) in MATCH_RATIOS.items())}
    FROM raw_match r LEFT JOIN stg_alias a ON trim(lower(r.player_id)) = a.alias
    WHERE r.match_date IS NOT NULL AND r.player_id IS NOT NULL
      AND r.winners >= 0 AND r.unforced_errors >= 0""")
cte("stg_training", ("raw_training", "stg_alias"), f"""
    SELECT coalesce(a.canonical_player_id, trim(lower(r.player_id))) AS player_id,
           {', '.join(f'r.{c}' for c in TRAINING_STAGED if c != 'player_id')}
    FROM raw_training r LEFT JOIN stg_alias a ON trim(lower(r.player_id)) = a.alias
    WHERE r.session_date IS NOT NULL AND r.player_id IS NOT NULL AND r.shots_in BETWEEN 0 AND 1""")
cte("stg_student", ("raw_student",), """
    SELECT student_id, intake_id, full_name, trim(lower(preferred_name)) AS preferred_name,
           utr_rating, age_group, lower(dominant_hand) AS dominant_hand,
           lower(competition_level) AS competition_level, training_frequency_per_week,
           years_playing, coach_id, submitted_at, valid_from, is_current
    FROM raw_student WHERE is_current""")

MATCH_FACT = (
    "match_id", "player_id", "match_date", "session_time", "score", "player_won", "winners",
    "unforced_errors", "forehand_winners", "backhand_winners", "total_points_won_pct",
    "break_point_conversion", "break_points_saved_pct", "first_serve_pct", "second_serve_pct",
    "first_serves_won_pct", "second_serves_won_pct", "return_points_won_pct", "rallies_1_4_won_pct",
    "rallies_5_8_won_pct", "rallies_9plus_won_pct", "raw_note_text", "extraction_confidence")


def strength(weight: str) -> str:
    return f"""
    SELECT {', '.join(MATCH_FACT)}, {weight} AS opponent_strength_weight,
           CASE WHEN player_won THEN {weight} ELSE 0.0e0 END AS weighted_win,
           {week('match_date')} AS match_week, {month('match_date')} AS match_month,
           {ym('match_date')} AS match_year_month
    FROM stg_match"""


cte("match_strength", ("stg_match",), strength("1.0e0"))
cte("daily_rollup", ("stg_training",), f"""
    SELECT player_id, session_date, count(*) AS sessions_on_day,
           {n('sum(shots_per_hour)')} AS total_shots_per_hour, max(longest_rally) AS max_longest_rally,
           {', '.join(f'{mean(c, 4)} AS {out}' for c, out in TRAINING_ACCURACIES.items())},
           {', '.join(f'{mean(c, 1)} AS {out}' for c, out in TRAINING_SPEEDS.items())},
           {mean('extraction_confidence', 4)} AS avg_extraction_confidence,
           {week('session_date')} AS session_week, {month('session_date')} AS session_month,
           {ym('session_date')} AS session_year_month
    FROM stg_training GROUP BY player_id, session_date""")
cte("linked", ("daily_rollup", "match_strength"), """
    SELECT t.player_id, t.session_date AS training_date, t.avg_shots_in, t.avg_forehand_cross_court_in,
           t.avg_backhand_cross_court_in, t.sessions_on_day, m.match_id, m.match_date, m.player_won,
           m.weighted_win, m.opponent_strength_weight, m.total_points_won_pct, m.break_point_conversion,
           m.first_serve_pct, m.raw_note_text,
           CAST(m.match_date - t.session_date AS INTEGER) AS days_to_match,
           m.match_id IS NOT NULL AS has_linked_match, 1 AS match_rank
    FROM daily_rollup t LEFT JOIN match_strength m
      ON t.player_id = m.player_id AND m.match_date BETWEEN t.session_date AND t.session_date + 7
    QUALIFY row_number() OVER (PARTITION BY t.player_id, t.session_date
                               ORDER BY m.match_date NULLS LAST, m.session_time, m.match_id) = 1""")
cte("dim_player", ("stg_student",), f"""
    SELECT {key('student_id', 'valid_from')} AS player_sk, student_id AS player_id, preferred_name,
           full_name, utr_rating, age_group, dominant_hand, competition_level, coach_id,
           submitted_at, valid_from, is_current
    FROM stg_student""")
cte("fct_match", ("match_strength", "dim_player"), f"""
    SELECT m.*, d.player_sk, {key('m.match_id')} AS match_sk, m.raw_note_text IS NOT NULL AS has_note
    FROM match_strength m LEFT JOIN dim_player d ON m.player_id = d.player_id""")
cte("fct_training", ("daily_rollup", "dim_player"), f"""
    SELECT s.*, d.player_sk, {key('s.player_id', 's.session_date')} AS session_sk
    FROM daily_rollup s LEFT JOIN dim_player d ON s.player_id = d.player_id""")

cte("match_weeks", ("fct_match",), f"""
    SELECT player_id, player_sk, match_week AS score_week,
           {mean('weighted_win', 4)} AS weighted_win_rate,
           {mean('opponent_strength_weight', 4)} AS avg_opponent_strength,
           {mean('break_point_conversion', 4)} AS avg_break_point_conversion,
           count(*) AS matches_played, count(*) FILTER (player_won) AS matches_won
    FROM fct_match GROUP BY ALL""")
cte("training_weeks", ("fct_training",), f"""
    SELECT player_id, player_sk, session_week AS score_week,
           {mean('(coalesce(avg_forehand_cross_court_in, 0) + coalesce(avg_backhand_cross_court_in, 0)) / 2', 4)}
             AS avg_technique_score,
           count(*) AS sessions_completed, {mean('total_shots_per_hour', 1)} AS avg_shots_per_hour
    FROM fct_training GROUP BY ALL""")
cte("weeks", ("match_weeks", "training_weeks"), """
    SELECT coalesce(m.player_id, t.player_id) AS player_id, coalesce(m.player_sk, t.player_sk) AS player_sk,
           coalesce(m.score_week, t.score_week) AS score_week,
           coalesce(weighted_win_rate, 0) AS weighted_win_rate,
           coalesce(avg_opponent_strength, 1.0) AS avg_opponent_strength,
           coalesce(avg_technique_score, 0) AS avg_technique_score,
           coalesce(avg_break_point_conversion, 0) AS avg_break_point_conversion,
           coalesce(matches_played, 0) AS matches_played, coalesce(matches_won, 0) AS matches_won,
           coalesce(sessions_completed, 0) AS sessions_completed,
           coalesce(avg_shots_per_hour, 0) AS avg_shots_per_hour
    FROM match_weeks m FULL OUTER JOIN training_weeks t
      ON m.player_id = t.player_id AND m.score_week = t.score_week""")
cte("parts", ("weeks",), """
    SELECT *, least(100, CAST(weighted_win_rate AS DECIMAL(16, 4)) * 50) AS w,
           least(100, greatest(0, CAST((CAST(avg_opponent_strength AS DECIMAL(6, 4)) - 0.5) / 1.5
                                       AS DECIMAL(11, 7)) * 100)) AS s,
           least(100, avg_technique_score * 100) AS t, least(100, avg_break_point_conversion * 100) AS b
    FROM weeks""")
cte("score", ("parts",), f"""
    SELECT player_id, player_sk, score_week, weighted_win_rate, avg_opponent_strength,
           avg_technique_score, avg_break_point_conversion, matches_played, matches_won,
           sessions_completed, avg_shots_per_hour,
           {rnd('w', 2)} AS win_rate_score, {rnd('s', 2)} AS opponent_strength_score,
           {rnd('t', 2)} AS technique_score, {rnd('b', 2)} AS break_point_score,
           {rnd('CAST(w * 0.40 + s * 0.30 AS DOUBLE) + t * 0.20e0 + b * 0.10e0', 2)} AS development_score
    FROM parts""")
cte("digest", ("score",), f"""
    SELECT player_id, player_sk, score_week AS week_start, development_score, matches_played,
           matches_won, sessions_completed, avg_shots_per_hour, prior_week_score,
           development_score - prior_week_score AS score_change,
           CASE WHEN development_score - prior_week_score > 2 THEN 'improving'
                WHEN development_score - prior_week_score < -2 THEN 'declining'
                ELSE 'stable' END AS score_trend,
           {key('player_id', 'score_week')} AS digest_id
    FROM (SELECT *, lag(development_score) OVER (PARTITION BY player_id ORDER BY score_week)
                      AS prior_week_score FROM score)""")
cte("report", ("fct_match", "fct_training", "score"), f"""
    SELECT {key('mm.player_id', 'mm.report_month')} AS report_id, mm.*,
           coalesce(sessions_completed, 0) AS sessions_completed, avg_shots_per_hour,
           development_score, score_range
    FROM (SELECT player_id, {ym('match_date')} AS report_month, count(*) AS matches_played,
                 count(*) FILTER (player_won) AS matches_won,
                 {rnd('count(*) FILTER (player_won) / count(*)', 4)} AS win_rate,
                 {mean('first_serve_pct', 4)} AS avg_first_serve_pct,
                 {mean('break_point_conversion', 4)} AS avg_break_point_conversion
          FROM fct_match GROUP BY ALL) mm
    LEFT JOIN (SELECT player_id, {ym('session_date')} AS report_month, count(*) AS sessions_completed,
                      {mean('total_shots_per_hour', 1)} AS avg_shots_per_hour
               FROM fct_training GROUP BY ALL) mt USING (player_id, report_month)
    LEFT JOIN (SELECT player_id, {ym('score_week')} AS report_month,
                      {mean('development_score', 2)} AS development_score,
                      {rnd('max(development_score) - min(development_score)', 2)} AS score_range
               FROM score GROUP BY ALL) ms USING (player_id, report_month)""")
