"""Full or incremental build of the gold tables from bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.plans import intermediate, marts, staging
from podium.sources.readers import table, table_exists
from podium.sources.sinks import publish, upsert_partitions


def build(raw_matches: DataFrame, raw_training: DataFrame, raw_students: DataFrame, alias_seed: DataFrame,
          folder: str, now: Column | None = None) -> dict[str, DataFrame]:
    """Write the gold tables below ``folder`` and return every model.

    Silver models stay views. Facts and scores are stored before the marts read them, so each is
    computed once per build however many marts use it; each is published whole, so a dashboard that reads during
    a build sees the rows before or after it. Digest and report are compared with what is
    stored, and only the partitions with new or changed rows are rewritten.
    """
    alias = staging.stg_alias(alias_seed)
    views = {
        "stg_alias": alias,
        "stg_match": staging.stg_match(raw_matches, alias),
        "stg_training": staging.stg_training(raw_training, alias),
        "stg_student": staging.stg_student(raw_students),
    }
    views["match_strength"] = intermediate.match_strength(views["stg_match"])
    views["daily_rollup"] = intermediate.daily_rollup(views["stg_training"])
    views["link_to_match"] = intermediate.link_to_match(views["daily_rollup"], views["match_strength"])

    dim = publish(marts.dim_player(views["stg_student"]), f"{folder}/dim_player")
    matches = publish(marts.fct_match(views["match_strength"], dim), f"{folder}/fct_match",
                      ["match_year_month"], ["player_id", "match_date"])
    training = publish(marts.fct_training(views["daily_rollup"], dim), f"{folder}/fct_training",
                       ["session_year_month"], ["player_id", "session_date"])
    score = publish(calculated(marts.development_score(matches, training), now), f"{folder}/development_score")
    digest = refresh_digest(score, f"{folder}/weekly_digest", now)
    report = refresh_report(matches, training, score, f"{folder}/monthly_report", now)
    return {**views, "dim_player": dim, "fct_match": matches, "fct_training": training,
            "development_score": score, "weekly_digest": digest, "monthly_report": report}


def refresh_digest(score: DataFrame, target: str, now: Column | None = None) -> DataFrame:
    """Bring the stored digest up to ``score``: new weeks, late rows, corrections, the changes after them, and removals."""
    changes = _changed(marts.weekly_digest(score), target, "digest_id", "week_start", now)
    upsert_partitions(changes, target, ["digest_id"], "week_start", deleted="_deleted")
    return table(score.sparkSession, target)


def refresh_report(matches: DataFrame, training: DataFrame, score: DataFrame, target: str,
                   now: Column | None = None) -> DataFrame:
    """Bring the stored report up to its inputs, whichever months new, corrected or removed rows fall into."""
    changes = _changed(marts.monthly_report(matches, training, score), target, "report_id", "report_month", now)
    upsert_partitions(changes, target, ["report_id"], "report_month", deleted="_deleted")
    return table(score.sparkSession, target)


def calculated(df: DataFrame, now: Column | None = None) -> DataFrame:
    """When the row was worked out; ``now`` makes a rebuild repeatable."""
    return df.withColumn("calculated_at", F.current_timestamp() if now is None else now)


def _changed(fresh: DataFrame, target: str, key: str, partition: str, now: Column | None) -> DataFrame:
    """Rows of ``fresh`` that ``target`` does not hold as they are, and, as ``_deleted``, keys it holds in vain.

    Both sides are brought together on the key, with a hash of what each row says. The key is made of the
    partition's value, whose type a folder does not keep; it is not hashed. This compares whole tables, as a build of
    everything does; ``podium.plans.refresh`` carries single changes.
    """
    spark = fresh.sparkSession
    rows = calculated(fresh, now).withColumn("_deleted", F.lit(False))
    if not table_exists(spark, target):
        return rows
    said = [c for c in fresh.columns if c != partition]
    state = F.xxhash64(F.to_json(F.struct(*said)))  # by name, as a hash of the columns would pass over nulls
    held = table(spark, target).select(F.col(key).alias("_key"), F.col(partition).alias("_partition"), state.alias("_held"))
    both = rows.withColumn("_state", state).join(held, F.col(key) == F.col("_key"), "full")
    changed = F.col("_key").isNull() | F.col(key).isNull() | (F.col("_state") != F.col("_held"))
    kind = fresh.schema[partition].dataType
    return both.filter(changed).withColumns({
        "_deleted": F.col(key).isNull(), partition: F.coalesce(partition, F.col("_partition").cast(kind)),
        key: F.coalesce(key, "_key")}).drop("_key", "_partition", "_held", "_state")
