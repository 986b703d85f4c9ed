"""Silver staging: alias resolution, typing, guarded ratios, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.predicates import current, non_negative, require
from podium.functions.scalars import safe_ratio
from podium.operators.conform import conform
from podium.operators.joins import resolve_alias
from podium.schemas import MATCH_RATIOS, RAW_MATCHES, RAW_STUDENTS, RAW_TRAINING

# Bronze columns that staging does not carry on.
_MATCH_BRONZE_ONLY = ("tournament_name", "surface", "pages_processed", "source_file",
                      "serve_points_won", "serve_points_total")
_TRAINING_BRONZE_ONLY = ("pages_processed", "source_file")
_STUDENT_COLUMNS = (
    "student_id", "intake_id", "full_name", "chinese_name", "preferred_name", "date_of_birth",
    "utr_rating", "age_group", "dominant_hand", "height", "years_playing",
    "training_frequency_per_week", "competition_level", "coach_id", "goals", "injury_history",
    "previous_coaching", "contact_name", "contact_email", "submitted_at", "is_current",
    "valid_from", "valid_to",
)


def stg_alias(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.trim(F.lower("alias")).alias("alias"),
        F.trim(F.lower("canonical_player_id")).alias("canonical_player_id"),
        F.trim("alias_source").alias("alias_source"))


def stg_match(raw: DataFrame, alias: DataFrame) -> DataFrame:
    """One row per valid match, with the thirteen ratios."""
    typed = conform(raw, RAW_MATCHES)
    valid = require(typed, ["match_date", "player_id"]).filter(non_negative(["winners", "unforced_errors"]))
    ratios = {name: safe_ratio(*parts) for name, parts in MATCH_RATIOS.items()}
    return resolve_alias(valid.drop(*_MATCH_BRONZE_ONLY), "player_id", alias).withColumns(ratios)


def stg_training(raw: DataFrame, alias: DataFrame) -> DataFrame:
    """One row per valid session; a session without ``shots_in`` is not valid."""
    typed = conform(raw, RAW_TRAINING)
    valid = require(typed, ["session_date", "player_id"]).filter(F.col("shots_in").between(0, 1))
    return resolve_alias(valid.drop(*_TRAINING_BRONZE_ONLY), "player_id", alias)


def stg_student(raw: DataFrame) -> DataFrame:
    """Current student profiles."""
    typed = current(conform(raw, RAW_STUDENTS))
    return typed.withColumns({
        "preferred_name": F.trim(F.lower("preferred_name")),
        "dominant_hand": F.lower("dominant_hand"),
        "competition_level": F.lower("competition_level"),
    }).select(*_STUDENT_COLUMNS)
