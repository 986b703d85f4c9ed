"""Semantic audit: does a coaching note contradict the figures of its session?

The judge is supplied by the caller, as the page reader is in ``podium.plans.extraction``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.scalars import deterministic_id, rank_of, safe_ratio
from podium.operators.conform import conform
from podium.operators.joins import new_only
from podium.operators.windows import dedupe
from podium.schemas import FINDINGS, declare
from podium.session import scratch_dir
from podium.sources.readers import table, table_exists
from podium.sources.sinks import insert_new, materialize

# The functions run on workers that may not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Takes the note and the statistics text, returns the verdict.
Judge = Callable[[str, str], dict]

SEVERITIES = ("high", "medium", "low")
_VERDICT = declare(
    "BOOLEAN has_inconsistency",
    "STRING inconsistency_type severity description note_excerpt stat_evidence error",
)
_CASE = ("session_id", "session_type", "player_id", "session_date", "raw_note_text")


def audit_context(df: DataFrame, kind: str) -> DataFrame:
    """Noted sessions with the figures put before the judge; absent or zero ones read ``N/A``."""
    noted = df.filter(F.col("raw_note_text").isNotNull())
    if kind == "match":
        id_col, day = "match_id", "match_date"
        figures = {
            "Winners": F.coalesce(F.col("winners").cast("string"), F.lit("N/A")),
            "Unforced errors": F.coalesce(F.col("unforced_errors").cast("string"), F.lit("N/A")),
            "First serve %": _figure(safe_ratio("first_serves_in", "first_serves_total", 2)),
            "Break point conversion": _figure(safe_ratio("break_points_won", "break_points_total", 2)),
        }
    else:
        id_col, day = "session_id", "session_date"
        figures = {
            "Overall shots in": _figure(F.round("shots_in", 2)),
            "Forehand cross-court accuracy": _figure(F.round("forehand_cross_court_in", 2)),
            "Backhand cross-court accuracy": _figure(F.round("backhand_cross_court_in", 2)),
        }
    lines = [F.concat(F.lit(f"- {label}: "), text) for label, text in figures.items()]
    return noted.select(
        F.col(id_col).alias("session_id"), F.lit(kind).alias("session_type"), "player_id",
        F.col(day).alias("session_date"), "raw_note_text",
        F.concat_ws("\n", *lines).alias("statistics"))


def _figure(value: Column) -> Column:
    return F.when(value != 0, value.cast("string")).otherwise("N/A")


def audit(cases: DataFrame, judge: Judge) -> DataFrame:
    """Verdict per case; a failing call means no inconsistency, with the error kept."""
    schema = T.StructType([cases.schema[c] for c in _CASE] + _VERDICT.fields)
    fields = [f.name for f in schema if f.name not in _CASE]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            verdicts = []
            for note, statistics in zip(batch["raw_note_text"], batch["statistics"]):
                try:
                    verdict = dict(judge(note, statistics))
                except Exception as failure:
                    verdict = {"has_inconsistency": False, "error": f"{type(failure).__name__}: {failure}"}
                verdicts.append([verdict.get(f) for f in fields])
            found = pd.DataFrame(verdicts, columns=fields, dtype=object)
            yield pd.concat([batch[list(_CASE)].reset_index(drop=True), found], axis=1)

    return cases.mapInPandas(run, schema)


def findings_of(verdicts: DataFrame, now: Column) -> DataFrame:
    """Open findings for the inconsistent cases."""
    found = verdicts.filter(F.col("has_inconsistency")).withColumns({
        "finding_id": deterministic_id("session_type", "session_id"),
        "coach_status": F.lit("pending"),
        "audited_at": now,
    })
    return conform(found, FINDINGS)


def run_audit(matches: DataFrame, training: DataFrame, judge: Judge,
              existing: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """New findings, at most one per session and none for a session already in ``existing``."""
    now = F.current_timestamp() if now is None else now
    cases = audit_context(matches, "match").unionByName(audit_context(training, "training"))
    if existing is not None:  # before the calls: nothing is paid for a session already flagged
        cases = new_only(cases, existing, ["session_id"])
    return dedupe(findings_of(audit(cases, judge), now), ["session_id"],
                  [rank_of("severity", SEVERITIES), "finding_id"])


def store_audit(matches: DataFrame, training: DataFrame, judge: Judge, verdict_table: str, finding_table: str,
                calls_in_parallel: int | None = None, now: Column | None = None) -> None:
    """Judge the sessions without a verdict, and keep every verdict, failed calls with their error.

    A failed call is tried again by the next run. Verdicts are written once before they are routed;
    findings come first, so that a run that breaks off pays for calls again but loses none.
    """
    spark, now = matches.sparkSession, F.current_timestamp() if now is None else now
    cases = audit_context(matches, "match").unionByName(audit_context(training, "training"))
    if table_exists(spark, verdict_table):
        cases = new_only(cases, table(spark, verdict_table).filter("error IS NULL"), ["session_type", "session_id"])
    tasks = calls_in_parallel or int(spark.conf.get("spark.sql.shuffle.partitions"))
    verdicts = audit(cases.repartition(tasks, "session_type", "session_id"), judge).withColumn("audited_at", now)
    fresh = materialize(verdicts, scratch_dir(spark, "verdicts"))
    insert_new(findings_of(fresh, F.col("audited_at")), finding_table, ["session_id"],
               [rank_of("severity", SEVERITIES), "finding_id"])
    insert_new(fresh, verdict_table, ["session_type", "session_id", "audited_at"], ["raw_note_text"])
