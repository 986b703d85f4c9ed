"""Data checks over the given tables and the models."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.plans import intermediate, quality
from podium.plans.build import build
from podium.session import scratch_dir
from podium.sources.readers import load_contract
from workload.models import Models
from workload.registry import query
from workload.sql import rnd, with_ctes
from workload.tables import Tables

_AS_OF = "2024-01-20"

# A model's table expression in the oracle's SQL.
_CTE_OF = {"stg_alias": "stg_alias", "stg_match": "stg_match", "stg_training": "stg_training",
           "stg_student": "stg_student", "match_strength": "match_strength", "daily_rollup": "daily_rollup",
           "link_to_match": "linked", "dim_player": "dim_player", "fct_match": "fct_match",
           "fct_training": "fct_training", "development_score": "score", "weekly_digest": "digest",
           "monthly_report": "report"}


def _rule_sql(check: quality.Check) -> str:
    c = check.column
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "accepted_values":
        return f"{c} NOT IN ({', '.join(repr(v) for v in check.args)})"
    if check.kind == "range":
        return f"{c} < {check.args[0]} OR {c} > {check.args[1]}"
    return f"{c} > DATE '{_AS_OF}'"


def _report_sql(name: str, table: str, checks) -> str:
    parts = []
    for check in checks:
        c = check.column
        broken = (f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
                  if check.kind == "unique" else f"{table} WHERE {_rule_sql(check)}")
        parts.append(f"""SELECT '{check.kind}' AS "check", '{name}' AS table_name, '{c}' AS column_name,
                                (SELECT count(*) FROM {broken}) AS violations""")
    return "\nUNION ALL ".join(parts)


def _models(t: Tables) -> dict[str, DataFrame]:
    m = Models(t)
    return {"stg_alias": m.alias, "stg_match": m.stg_match, "stg_training": m.stg_training,
            "stg_student": m.stg_student, "match_strength": m.match_strength, "daily_rollup": m.daily_rollup,
            "link_to_match": intermediate.link_to_match(m.daily_rollup, m.match_strength),
            "dim_player": m.dim_player}


def _suite(*names: str) -> dict[str, tuple[quality.Check, ...]]:
    return {name: quality.MODEL_CHECKS[name] for name in names}


def _suite_sql(*names: str) -> str:
    body = "\nUNION ALL ".join(_report_sql(name, _CTE_OF[name], quality.MODEL_CHECKS[name]) for name in names)
    return with_ctes(body, *[_CTE_OF[name] for name in names])


_STAGED = ("stg_alias", "stg_match", "stg_training", "stg_student")
_BUILT = ("match_strength", "daily_rollup", "link_to_match", "dim_player")
_SERVED = ("fct_match", "fct_training", "development_score", "weekly_digest", "monthly_report")


@query(_suite_sql(*_STAGED))
def check_staging(t: Tables) -> DataFrame:
    return quality.run_suite(_models(t), _suite(*_STAGED), F.lit(_AS_OF).cast("date"))


@query(_suite_sql(*_BUILT))
def check_intermediate(t: Tables) -> DataFrame:
    return quality.run_suite(_models(t), _suite(*_BUILT), F.lit(_AS_OF).cast("date"))


@query(_suite_sql(*_SERVED))
def check_marts(t: Tables) -> DataFrame:
    """Full build of the gold tables, then the rules over what was stored."""
    stored = build(t.raw_matches, t.raw_training, t.raw_students, t.alias_seed, scratch_dir(t.spark, "gold"))
    return quality.run_suite(stored, _suite(*_SERVED), F.lit(_AS_OF).cast("date"))


_RAW_RULES = (
    quality.unique("l_orderkey"), quality.not_null("l_shipdate"), quality.in_range("l_discount", 0.02, 0.08),
    quality.accepted("l_returnflag", "A", "N"), quality.not_future("l_shipdate"))


@query(_report_sql("lineitem", "lineitem", _RAW_RULES).replace(f"DATE '{_AS_OF}'", "TIMESTAMP '2000-01-01'"))
def check_line_items(t: Tables) -> DataFrame:
    """Rules that the table does break: four in one pass, duplicates in one grouping."""
    return quality.run_checks(t.lineitem, "lineitem", _RAW_RULES, F.lit("2000-01-01").cast("timestamp"))


@query("SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.failing_rows(t.lineitem, quality.unique("l_orderkey"))


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08")
def failing_rows(t: Tables) -> DataFrame:
    return quality.failing_rows(t.lineitem, quality.in_range("l_discount", 0.02, 0.08)).select(
        "l_orderkey", "l_linenumber", "l_discount")


@query(f"""
    SELECT loaded_at, {rnd("date_diff('microsecond', loaded_at, TIMESTAMP '2024-02-01 12:00:00') / 3600000000", 2)} AS age_hours,
           'warn' AS status
    FROM (SELECT max(ts) AS loaded_at FROM events)""")
def freshness(t: Tables) -> DataFrame:
    return quality.check_freshness(t.events, "ts", F.lit("2024-02-01 12:00:00").cast("timestamp"))


@query("""
    SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS unique_ids,
           count(*) = count(DISTINCT l_orderkey) AS idempotent FROM lineitem""")
def idempotency(t: Tables) -> DataFrame:
    return quality.check_idempotent(t.lineitem, "l_orderkey")


_CONTRACTS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "contracts")


def _contract_sql(name: str, table: str, required: tuple[str, ...], fresh: str) -> str:
    parts = [f"""SELECT 'min_rows' AS "check", '{name}' AS table_name, '' AS column_name,
                        CAST((SELECT count(*) < 1 FROM {table}) AS BIGINT) AS violations"""]
    parts += [f"SELECT 'null_violation', '{name}', '{c}', (SELECT count(*) FROM {table} WHERE {c} IS NULL)"
              for c in required]
    parts.append(f"""SELECT 'freshness', '{name}', '_ingested_at',
                            CAST((SELECT max(_ingested_at) < {fresh} FROM {table}) AS BIGINT)""")
    return "\nUNION ALL ".join(parts)


@query(with_ctes(
    _contract_sql("raw_match_extractions", "raw_match",
                  ("match_id", "player_id", "match_date", "extraction_confidence"), "TIMESTAMP '2024-02-01'")
    + "\nUNION ALL "
    + _contract_sql("raw_training_sessions", "raw_training",
                    ("session_id", "player_id", "session_date", "extraction_confidence"), "TIMESTAMP '2024-02-01'")
    + "\nUNION ALL SELECT 'missing_column', 'raw_training_sessions', 'forehand_cross_court_in', 1"
    + "\nUNION ALL SELECT 'wrong_type', 'raw_training_sessions', 'shots_in', 1",
    "raw_match", "raw_training"))
def contracts(t: Tables) -> DataFrame:
    """Both contracts; the training table lacks a column and holds text where a number is due."""
    now = F.lit("2024-02-04").cast("timestamp")
    broken = t.raw_training.drop("forehand_cross_court_in").withColumn("shots_in", F.col("shots_in").cast("string"))
    tables = {"raw_match_extractions": t.raw_matches, "raw_training_sessions": broken}
    reports = [quality.validate_contract(df, load_contract(f"{_CONTRACTS}/{name}.yml"), t.spark, now)
               for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)


_APPROVED = "CASE WHEN quality = 1 THEN 'neutral' ELSE 'needs_work' END"
_FOUND = "CASE WHEN n_chars < 500 THEN 'needs_work' WHEN n_chars < 5000 THEN 'neutral' END"


def _graded(t: Tables) -> tuple[DataFrame, DataFrame]:
    approved = t.labels.selectExpr("CAST(doc_id AS STRING) AS session_id", f"{_APPROVED} AS sentiment", "toxic AS version")
    found = t.documents.selectExpr("CAST(doc_id AS STRING) AS event_id", f"{_FOUND} AS sentiment")
    return approved, found


_JOINED = f"SELECT {_APPROVED} AS approved, {_FOUND} AS found, toxic FROM labels JOIN documents USING (doc_id)"


@query(f"""
    SELECT count(*) AS total, count(*) FILTER (approved = found) AS correct,
           {rnd('count(*) FILTER (approved = found) / count(*)', 4)} AS accuracy
    FROM ({_JOINED})""")
def extraction_accuracy(t: Tables) -> DataFrame:
    return quality.extraction_accuracy(*_graded(t))


@query(f"""
    SELECT toxic AS version, count(*) AS total, count(*) FILTER (approved = found) AS correct,
           {rnd('count(*) FILTER (approved = found) / count(*)', 4)} AS accuracy
    FROM ({_JOINED}) GROUP BY 1""")
def accuracy_by_version(t: Tables) -> DataFrame:
    return quality.extraction_accuracy(*_graded(t), by=["version"])


@query(f"""
    SELECT table_name, day, rows, {rnd('avg(rows) OVER w', 2)} AS usual_rows,
           {rnd('stddev_pop(rows) OVER w', 2)} AS deviation,
           count(*) OVER w = 7 AND coalesce(abs(rows - avg(rows) OVER w) > 1.5 * stddev_pop(rows) OVER w, false) AS unusual
    FROM (SELECT event_type AS table_name, CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY ALL)
    WINDOW w AS (PARTITION BY table_name ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def volume_monitor(t: Tables) -> DataFrame:
    """Each event type is read as a table that is loaded daily."""
    daily = quality.daily_volume(t.events, F.col("event_type"), "ts")
    return quality.volume_monitor(daily, 7, 1.5)
