"""The given tables, and the shape the models expect derived from them.

``events`` stands in for matches (``purchase`` won, ``error`` lost), training sessions (``view``,
``click``) and intake forms (``signup``); ``customer`` for players; ``conversations`` for sessions
of several pages. The column formulas are plain SQL text, shared with the oracle's own derivation.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.operators.conform import conform
from podium.schemas import RAW_MATCHES, RAW_STUDENTS, RAW_TRAINING, TRAINING_ACCURACIES, TRAINING_SPEEDS

# v: whole part of the event's value, k: the number in its properties (0-99).
MATCH_EXPR = {
    "match_id": "concat('m', event_id)",
    "player_id": "concat(case when k < 50 then ' P' else 'p' end, user_id, case when k < 50 then ' ' else '' end)",
    "match_date": "cast(ts as date)",
    "opponent_utr": "case when k >= 20 then value / 30 end",
    "score": "concat(v, '-', k)",
    "player_won": "case when k > 0 then event_type = 'purchase' end",
    "winners": "case when k = 1 then null when k = 2 then -1 else v end",
    "unforced_errors": "k",
    "forehand_winners": "least(v, k)",
    "forehand_unforced_errors": "least(k, 20)",
    "backhand_winners": "least(v, 30)",
    "backhand_unforced_errors": "least(k, 10)",
    "total_points_won": "v",
    "total_points_played": "v + k",
    "break_points_won": "least(v, k)",
    "break_points_total": "k",
    "break_points_saved": "least(k, v)",
    "break_points_saved_total": "v",
    "aces": "least(k, 15)",
    "service_winners": "least(v, 25)",
    "double_faults": "least(k, 9)",
    "first_serves_in": "least(v, k + 10)",
    "first_serves_total": "k + 10",
    "second_serves_in": "least(k, v + 1)",
    "second_serves_total": "v + 1",
    "serve_points_won": "least(v, 2 * k)",
    "serve_points_total": "2 * k",
    "first_serves_won": "least(v, 3 * k)",
    "first_serves_won_total": "3 * k",
    "second_serves_won": "least(k, 2 * v)",
    "second_serves_won_total": "2 * v",
    "return_points_won": "k",
    "return_points_total": "v + 2 * k",
    "first_returns_won": "least(v, k + 5)",
    "first_returns_total": "k + 5",
    "second_returns_won": "least(k, v + 7)",
    "second_returns_total": "v + 7",
    "rallies_1_4_won": "least(k, v + 3)",
    "rallies_1_4_total": "v + 3",
    "rallies_5_8_won": "least(v, 2 * k + 1)",
    "rallies_5_8_total": "2 * k + 1",
    "rallies_9plus_won": "least(v, greatest(k - 50, 0))",
    "rallies_9plus_total": "greatest(k - 50, 0)",
    "raw_note_text": "case when k >= 30 then concat(event_type, ' note ', event_id) end",
    "pages_processed": "least(k, 4)",
    "source_file": "concat('s', event_id)",
    "extraction_confidence": "least(1.0e0, value / 100)",
    "prompt_version": "case when k < 25 then 'synthetic' when k < 60 then 'v1.0' else 'v1.1' end",
    "_ingested_at": "ts",
}

_RATIO = "cast({} as double) / {}"
_SERVED = "case when k >= 30 then {} end"
TRAINING_EXPR = {
    "session_id": "concat('t', event_id)",
    "player_id": MATCH_EXPR["player_id"],
    "session_date": "cast(ts as date)",
    "session_type": "'training'",
    "raw_note_text": MATCH_EXPR["raw_note_text"],
    "shots_in": "case when k > 0 then value / 100 end",
    "rallies_above_5_shots": _RATIO.format("k", 100),
    "serves_in_ad": _SERVED.format(_RATIO.format("k", 128)),
    "serves_in_deuce": _SERVED.format(_RATIO.format("k", 160)),
    "returns_in_ad": _SERVED.format(_RATIO.format("k", 125)),
    "returns_in_deuce": _SERVED.format(_RATIO.format("k", 200)),
    "forehand_cross_court_in": _RATIO.format("k", 100),
    "forehand_down_the_line_in": _RATIO.format("(100 - k)", 100),
    "forehand_cross_court_deep": _RATIO.format("k", 250),
    "forehand_down_the_line_deep": _RATIO.format("(100 - k)", 250),
    "backhand_cross_court_in": "case when k < 90 then cast(100 - k as double) / 100 end",
    "backhand_down_the_line_in": _RATIO.format("least(v, 100)", 100),
    "backhand_cross_court_deep": _RATIO.format("k", 400),
    "backhand_down_the_line_deep": _RATIO.format("(100 - k)", 400),
    "shots_per_hour": "100 + 2 * k + v",
    "longest_rally": "v",
    "avg_serve_speed_ad": _SERVED.format("60 + k"),
    "avg_serve_speed_deuce": _SERVED.format("65 + k"),
    "forehand_avg_cross_court_speed": "50 + k",
    "forehand_avg_down_the_line_speed": "55 + k",
    "backhand_avg_cross_court_speed": "45 + k",
    "backhand_avg_down_the_line_speed": "48 + least(v, 60)",
    "avg_return_speed_ad": _SERVED.format("40 + k"),
    "avg_return_speed_deuce": _SERVED.format("42 + k"),
    "pages_processed": "least(k, 4)",
    "source_file": "concat('s', event_id)",
    "extraction_confidence": "least(1.0e0, value / 80)",
    "prompt_version": MATCH_EXPR["prompt_version"],
    "_ingested_at": "ts",
}
assert set(TRAINING_ACCURACIES) | set(TRAINING_SPEEDS) <= set(TRAINING_EXPR)

STUDENT_EXPR = {
    "student_id": "concat('player-', c_custkey)",
    "intake_id": "concat('i', c_custkey)",
    "full_name": "c_name",
    "preferred_name": "concat('  P', c_custkey, ' ')",
    "utr_rating": "c_acctbal / 500",
    "age_group": "case when c_nationkey < 5 then 'U10' when c_nationkey < 12 then 'U14' else 'Adult' end",
    "dominant_hand": "case when c_nationkey < 20 then 'Right' else 'Left' end",
    "competition_level":
        "case when c_mktsegment = 'BUILDING' then 'social' when c_nationkey < 15 then 'competitive' else 'recreational' end",
    "training_frequency_per_week": "least(c_nationkey, 7)",
    "years_playing": "c_nationkey",
    "coach_id": "concat('coach-', c_mktsegment)",
    "submitted_at": "'2024-01-01T00:00:00'",
    "valid_from": "timestamp '2024-01-01 00:00:00'",
    "is_active": "true",
    "is_current": "c_nationkey >= 3",
}


# What the footers said: read once per table, as a catalog would keep it.
_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """Lazy access to the given tables and to the shapes derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = self.path(name)
        reader = self.spark.read.schema(_SCHEMAS[path]) if path in _SCHEMAS else self.spark.read
        self.__dict__[name] = df = reader.parquet(path)
        _SCHEMAS[path] = df.schema
        return df

    @cached_property
    def numbered_events(self) -> DataFrame:
        return self.events.select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.floor("value").cast("bigint").alias("v"))

    @cached_property
    def raw_matches(self) -> DataFrame:
        return self._shaped(("purchase", "error"), MATCH_EXPR, RAW_MATCHES)

    @cached_property
    def raw_training(self) -> DataFrame:
        return self._shaped(("view", "click"), TRAINING_EXPR, RAW_TRAINING)

    def _shaped(self, kinds, formulas, schema) -> DataFrame:
        rows = self.numbered_events.filter(F.col("event_type").isin(*kinds))
        return conform(rows.selectExpr(
            "date_format(ts, 'HHmm') AS session_time",
            *[f"{text} AS {name}" for name, text in formulas.items()]), schema)

    @cached_property
    def raw_students(self) -> DataFrame:
        return conform(self.customer.selectExpr(
            *[f"{text} AS {name}" for name, text in STUDENT_EXPR.items()]), RAW_STUDENTS)

    @cached_property
    def alias_seed(self) -> DataFrame:
        """Registered players, written with padding and capitals; furniture buyers have no alias."""
        return self.customer.filter(F.col("c_mktsegment") != "FURNITURE").select(
            F.concat(F.lit(" P"), "c_custkey", F.lit("  ")).alias("alias"),
            F.concat(F.lit(" Player-"), "c_custkey").alias("canonical_player_id"),
            F.col("c_mktsegment").alias("alias_source"))
