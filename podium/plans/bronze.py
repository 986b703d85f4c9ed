"""Batch loads into the bronze layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.predicates import in_range_or_null, in_set_or_null, non_negative, not_provenance, require
from podium.operators.changes import replace_slice, unseen
from podium.operators.conform import conform, with_lineage
from podium.operators.windows import dedupe
from podium.schemas import RAW_MATCHES, RAW_TRAINING

# Valid rating range and competition levels.
RATING_RANGE = (0.0, 16.5)
COMPETITION_LEVELS = ("competitive", "recreational")


def valid_students(df: DataFrame) -> DataFrame:
    return (require(df, ["student_id", "full_name"])
            .filter(in_range_or_null("utr_rating", *RATING_RANGE))
            .filter(in_set_or_null("competition_level", COMPETITION_LEVELS)))


def valid_matches(df: DataFrame) -> DataFrame:
    return (require(df, ["match_id", "player_id", "match_date"])
            .filter(non_negative(["winners", "unforced_errors"])))


def ingest_matches(incoming: DataFrame, existing: DataFrame | None, source: str | Column,
                   version: str = "v2.0", now: Column | None = None) -> DataFrame:
    """Typed, checked match rows that the target does not hold yet, one per ``match_id``."""
    typed = conform(incoming, RAW_MATCHES)
    return with_lineage(
        unseen(valid_matches(typed), existing, ["match_id"], ["match_date", "session_time", "player_id"]),
        source, version, ["match_id"], now)


def ingest_training(incoming: DataFrame, existing: DataFrame, source: str | Column,
                    version: str = "v2.0", now: Column | None = None) -> DataFrame:
    """Next state of the training table: generated rows replaced, extracted ones kept."""
    fresh = dedupe(conform(incoming, RAW_TRAINING), ["session_id"], ["session_date", "session_time", "player_id"])
    return replace_slice(
        existing, with_lineage(fresh, source, version, ["session_id"], now),
        not_provenance("prompt_version", "synthetic"))


def note_observations(notes: DataFrame) -> DataFrame:
    """Staged note observations: one row per event and type, the most confident extraction."""
    return dedupe(
        require(notes, ["event_id", "event_type"]), ["event_id", "event_type"],
        [F.col("extraction_confidence").desc_nulls_last(), F.col("source_file").asc()])
