"""Declared schemas. Readers and writers conform to these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
    "DOUBLE": T.DoubleType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(), "BINARY": T.BinaryType(),
}


def declare(*groups: str) -> T.StructType:
    """Schema from groups such as ``"STRING match_id player_id"``, in the order given."""
    schema = T.StructType()
    for group in groups:
        kind, *names = group.split()
        for name in names:
            schema.add(name, _TYPES[kind])
    return schema


RAW_STUDENTS = declare(
    "STRING student_id intake_id full_name chinese_name preferred_name date_of_birth",
    "DOUBLE utr_rating",
    "STRING age_group",
    "INT training_frequency_per_week",
    "STRING dominant_hand height",
    "INT years_playing",
    "STRING coach_id submitted_at goals injury_history previous_coaching competition_level "
    "contact_name contact_email",
    "BIGINT kafka_offset",
    "INT kafka_partition",
    "STRING ingested_at",
    "BOOLEAN is_active",
    "TIMESTAMP valid_from valid_to",
    "BOOLEAN is_current",
)

# Ratio in the staged match <- (won, out of) columns of the raw match.
MATCH_RATIOS = {
    "total_points_won_pct": ("total_points_won", "total_points_played"),
    "break_point_conversion": ("break_points_won", "break_points_total"),
    "break_points_saved_pct": ("break_points_saved", "break_points_saved_total"),
    "first_serve_pct": ("first_serves_in", "first_serves_total"),
    "second_serve_pct": ("second_serves_in", "second_serves_total"),
    "first_serves_won_pct": ("first_serves_won", "first_serves_won_total"),
    "second_serves_won_pct": ("second_serves_won", "second_serves_won_total"),
    "return_points_won_pct": ("return_points_won", "return_points_total"),
    "first_returns_won_pct": ("first_returns_won", "first_returns_total"),
    "second_returns_won_pct": ("second_returns_won", "second_returns_total"),
    "rallies_1_4_won_pct": ("rallies_1_4_won", "rallies_1_4_total"),
    "rallies_5_8_won_pct": ("rallies_5_8_won", "rallies_5_8_total"),
    "rallies_9plus_won_pct": ("rallies_9plus_won", "rallies_9plus_total"),
}

MATCH_COUNTS = (
    "winners", "unforced_errors", "forehand_winners", "forehand_unforced_errors",
    "backhand_winners", "backhand_unforced_errors", "total_points_won", "total_points_played",
    "break_points_won", "break_points_total", "break_points_saved", "break_points_saved_total",
    "aces", "service_winners", "double_faults", "first_serves_in", "first_serves_total",
    "second_serves_in", "second_serves_total", "serve_points_won", "serve_points_total",
    "first_serves_won", "first_serves_won_total", "second_serves_won", "second_serves_won_total",
    "return_points_won", "return_points_total", "first_returns_won", "first_returns_total",
    "second_returns_won", "second_returns_total", "rallies_1_4_won", "rallies_1_4_total",
    "rallies_5_8_won", "rallies_5_8_total", "rallies_9plus_won", "rallies_9plus_total",
)

RAW_MATCHES = declare(
    "STRING match_id player_id",
    "DATE match_date",
    "STRING session_time opponent_name",
    "DOUBLE opponent_utr",
    "STRING tournament_name surface score",
    "BOOLEAN player_won",
    f"BIGINT {' '.join(MATCH_COUNTS)}",
    "STRING raw_note_text",
    "BIGINT pages_processed",
    "STRING source_file",
    "DOUBLE extraction_confidence",
    "STRING prompt_version",
    "TIMESTAMP _ingested_at",
)

# Accuracy (0-1) and speed columns of a training session, with the name of their daily average.
TRAINING_ACCURACIES = {
    "shots_in": "avg_shots_in",
    "rallies_above_5_shots": "avg_rallies_above_5_shots",
    "serves_in_ad": "avg_serves_in_ad",
    "serves_in_deuce": "avg_serves_in_deuce",
    "returns_in_ad": "avg_returns_in_ad",
    "returns_in_deuce": "avg_returns_in_deuce",
    "forehand_cross_court_in": "avg_forehand_cross_court_in",
    "forehand_down_the_line_in": "avg_forehand_down_the_line_in",
    "forehand_cross_court_deep": "avg_forehand_cross_court_deep",
    "forehand_down_the_line_deep": "avg_forehand_down_the_line_deep",
    "backhand_cross_court_in": "avg_backhand_cross_court_in",
    "backhand_down_the_line_in": "avg_backhand_down_the_line_in",
    "backhand_cross_court_deep": "avg_backhand_cross_court_deep",
    "backhand_down_the_line_deep": "avg_backhand_down_the_line_deep",
}
TRAINING_SPEEDS = {
    "avg_serve_speed_ad": "avg_serve_speed_ad",
    "avg_serve_speed_deuce": "avg_serve_speed_deuce",
    "forehand_avg_cross_court_speed": "avg_forehand_cross_court_speed",
    "forehand_avg_down_the_line_speed": "avg_forehand_down_the_line_speed",
    "backhand_avg_cross_court_speed": "avg_backhand_cross_court_speed",
    "backhand_avg_down_the_line_speed": "avg_backhand_down_the_line_speed",
}

RAW_TRAINING = declare(
    "STRING session_id player_id",
    "DATE session_date",
    "STRING session_time session_type drills_completed raw_note_text",
    f"DOUBLE {' '.join(TRAINING_ACCURACIES)}",
    f"BIGINT shots_per_hour longest_rally {' '.join(TRAINING_SPEEDS)}",
    "BIGINT avg_return_speed_ad avg_return_speed_deuce pages_processed",
    "STRING source_file",
    "DOUBLE extraction_confidence",
    "STRING prompt_version",
    "TIMESTAMP _ingested_at",
)

SESSION_FILES = declare(
    "STRING session_id",
    "DATE session_date",
    "STRING session_time player_name session_type",
    "INT page_number",
    "STRING filename",
    "BIGINT file_size_bytes",
    "STRING _source_file",
    "TIMESTAMP _ingested_at",
    "STRING _pipeline_version _record_hash",
)

# The fixed schema of Spark's binaryFile source; a stream has to be told.
BINARY_FILES = declare(
    "STRING path",
    "TIMESTAMP modificationTime",
    "BIGINT length",
    "BINARY content",
)

EXTRACTION_FAILURES = declare(
    "STRING failure_id source_file error_reason error_message",
    "INT retry_count",
    "STRING pipeline_version",
    "TIMESTAMP failed_at",
)

NOTE_EXTRACTIONS = declare(
    "STRING event_id event_type",
    "DATE event_date",
    "STRING coach_id player_id technique issue recommendation sentiment source_file",
    "DOUBLE extraction_confidence",
    "TIMESTAMP _ingested_at",
)

EVAL_SET = declare(
    "STRING session_id session_type player_id",
    "DATE session_date",
    "STRING raw_note_text technique issue recommendation sentiment",
    "TIMESTAMP approved_at",
)

FINDINGS = declare(
    "STRING finding_id session_id session_type player_id",
    "DATE session_date",
    "STRING inconsistency_type severity description note_excerpt stat_evidence coach_status",
    "TIMESTAMP audited_at",
)

ALIAS_SEED = declare(
    "STRING alias canonical_player_id alias_source",
)

# What the extraction function answers for one session.
COACHING_NOTES = declare(
    "STRING raw_note_text technique issue recommendation sentiment",
)
PAYLOAD = T.StructType([
    T.StructField("session_type", T.StringType()),
    T.StructField("screenshot_types_found", T.ArrayType(T.StringType())),
    T.StructField("pages_processed", T.LongType()),
    T.StructField("stats", T.StructType(
        [f for f in RAW_MATCHES.fields
         if f.name in ("opponent_name", "score", "player_won", *MATCH_COUNTS)]
        + [f for f in RAW_TRAINING.fields
           if f.name in ("shots_per_hour", "longest_rally", "avg_return_speed_ad",
                         "avg_return_speed_deuce", *TRAINING_ACCURACIES, *TRAINING_SPEEDS)])),
    T.StructField("coaching_notes", COACHING_NOTES),
    T.StructField("confidence", T.DoubleType()),
])

# Intake form question id -> column; the required ones must be answered.
INTAKE_FIELDS = {
    "field_001": "full_name", "field_002": "chinese_name", "field_003": "preferred_name",
    "field_004": "date_of_birth", "field_005": "utr_rating", "field_006": "dominant_hand",
    "field_007": "height", "field_008": "years_playing",
    "field_009": "training_frequency_per_week", "field_010": "competition_level",
    "field_011": "goals", "field_012": "injury_history", "field_013": "previous_coaching",
    "field_014": "contact_name", "field_015": "contact_email",
}
INTAKE_REQUIRED = (
    "full_name", "preferred_name", "date_of_birth", "years_playing",
    "training_frequency_per_week", "contact_name", "contact_email",
)
