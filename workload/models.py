"""The models, end to end from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from podium.plans import intermediate, marts, staging
from workload.registry import query
from workload.sql import strength, with_ctes
from workload.tables import Tables


class Models:
    """Every model over one set of tables, built on first use."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def alias(self) -> DataFrame:
        return staging.stg_alias(self.t.alias_seed)

    @cached_property
    def stg_match(self) -> DataFrame:
        return staging.stg_match(self.t.raw_matches, self.alias)

    @cached_property
    def stg_training(self) -> DataFrame:
        return staging.stg_training(self.t.raw_training, self.alias)

    @cached_property
    def stg_student(self) -> DataFrame:
        return staging.stg_student(self.t.raw_students)

    @cached_property
    def match_strength(self) -> DataFrame:
        return intermediate.match_strength(self.stg_match)

    @cached_property
    def daily_rollup(self) -> DataFrame:
        return intermediate.daily_rollup(self.stg_training)

    @cached_property
    def dim_player(self) -> DataFrame:
        return marts.dim_player(self.stg_student)

    @cached_property
    def fct_match(self) -> DataFrame:
        return marts.fct_match(self.match_strength, self.dim_player)

    @cached_property
    def fct_training(self) -> DataFrame:
        return marts.fct_training(self.daily_rollup, self.dim_player)

    @cached_property
    def score(self) -> DataFrame:
        return marts.development_score(self.fct_match, self.fct_training)

    @cached_property
    def digest(self) -> DataFrame:
        return marts.weekly_digest(self.score)

    @cached_property
    def report(self) -> DataFrame:
        return marts.monthly_report(self.fct_match, self.fct_training, self.score)


@query(with_ctes("SELECT * FROM stg_alias", "stg_alias"))
def stg_alias(t: Tables) -> DataFrame:
    return Models(t).alias


@query(with_ctes("SELECT * FROM stg_match", "stg_match"))
def stg_match(t: Tables) -> DataFrame:
    return Models(t).stg_match


@query(with_ctes("SELECT * FROM stg_training", "stg_training"))
def stg_training(t: Tables) -> DataFrame:
    return Models(t).stg_training


_STUDENT = ("student_id", "intake_id", "full_name", "preferred_name", "utr_rating", "age_group",
            "dominant_hand", "competition_level", "training_frequency_per_week", "years_playing",
            "coach_id", "submitted_at", "valid_from", "is_current")


@query(with_ctes("SELECT * FROM stg_student", "stg_student"))
def stg_student(t: Tables) -> DataFrame:
    return Models(t).stg_student.select(*_STUDENT)


@query(with_ctes("SELECT * FROM match_strength", "match_strength"))
def match_strength(t: Tables) -> DataFrame:
    return Models(t).match_strength


@query(with_ctes(
    strength("CASE WHEN opponent_utr IS NULL THEN 1.0e0 "
             "ELSE least(2.0e0, greatest(0.5e0, 1.0e0 + (opponent_utr - 7.0e0) / 10.0e0)) END"), "stg_match"))
def match_strength_rated(t: Tables) -> DataFrame:
    return intermediate.match_strength(Models(t).stg_match, rated=True)


@query(with_ctes("SELECT * FROM daily_rollup", "daily_rollup"))
def daily_rollup(t: Tables) -> DataFrame:
    return Models(t).daily_rollup


@query(with_ctes("SELECT * FROM linked", "linked"))
def link_to_match(t: Tables) -> DataFrame:
    m = Models(t)
    return intermediate.link_to_match(m.daily_rollup, m.match_strength)


_DIM = ("player_sk", "player_id", "preferred_name", "full_name", "utr_rating", "age_group",
        "dominant_hand", "competition_level", "coach_id", "submitted_at", "valid_from", "is_current")


@query(with_ctes("SELECT * FROM dim_player", "dim_player"))
def dim_player(t: Tables) -> DataFrame:
    return Models(t).dim_player.select(*_DIM)


@query(with_ctes("SELECT * FROM fct_match", "fct_match"))
def fct_match(t: Tables) -> DataFrame:
    return Models(t).fct_match


@query(with_ctes("SELECT * FROM fct_training", "fct_training"))
def fct_training(t: Tables) -> DataFrame:
    return Models(t).fct_training


@query(with_ctes("SELECT * FROM score", "score"))
def development_score(t: Tables) -> DataFrame:
    """Flagship: from raw events to the weekly composite score."""
    return Models(t).score


@query(with_ctes("SELECT * FROM digest", "digest"))
def weekly_digest(t: Tables) -> DataFrame:
    return Models(t).digest


@query(with_ctes("SELECT * FROM report", "report"))
def monthly_report(t: Tables) -> DataFrame:
    return Models(t).report
