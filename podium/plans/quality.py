"""Declarative data checks. Every check ends up as one row: check, table, column, violations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.aggregates import count_where
from podium.operators.summaries import match_accuracy
from podium.schemas import declare
from podium.sources.readers import table, table_exists

REPORT = declare("STRING check table_name column_name", "BIGINT violations")


@dataclass(frozen=True)
class Check:
    """A rule on one column. ``args``: allowed values of ``accepted``, bounds of ``range``."""

    kind: str
    column: str
    args: tuple = field(default=())


def unique(column: str) -> Check:
    return Check("unique", column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def accepted(column: str, *values: str) -> Check:
    return Check("accepted_values", column, values)


def in_range(column: str, low: float, high: float) -> Check:
    return Check("range", column, (low, high))


def not_future(column: str) -> Check:
    return Check("not_future", column)


def violation(check: Check, as_of: Column | None = None) -> Column:
    """Condition that holds for a row breaking the rule; null breaks only ``not_null``."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        return ~value.isin(*check.args)
    if check.kind == "range":
        return ~value.between(*check.args)
    if check.kind == "not_future":
        return value > (F.current_date() if as_of is None else as_of)
    raise ValueError(f"no row rule for {check.kind}")


def failing_rows(df: DataFrame, check: Check, as_of: Column | None = None) -> DataFrame:
    """The rows (or, for ``unique``, the keys) that break a rule."""
    if check.kind == "unique":
        return duplicate_keys(df, check.column)
    return df.filter(violation(check, as_of))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1))


def run_checks(df: DataFrame, name: str, checks: Sequence[Check], as_of: Column | None = None) -> DataFrame:
    """All rules of one table in one pass over it.

    A row gives an entry (rule, value) for every ``unique`` rule it has a value for, and (rule, null) for every
    other rule it breaks. Entries are counted once by rule and value, in the map tasks first, and what is
    counted more than once breaks a ``unique`` rule.
    """
    def entry(rule: int, value: Column, holds: Column) -> Column:
        return F.when(holds, F.struct(F.lit(rule).alias("rule"), value.alias("value")))

    nothing = F.lit(None).cast("string")
    entries = [entry(i, F.col(c.column).cast("string"), F.col(c.column).isNotNull()) if c.kind == "unique"
               else entry(i, nothing, violation(c, as_of)) for i, c in enumerate(checks)]
    told = df.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    counted = told.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.agg(*[
        (count_where((F.col("rule") == i) & (F.col("rows") > 1)) if c.kind == "unique"
         else F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("rows"))), F.lit(0))).alias(f"c{i}")
        for i, c in enumerate(checks)])
    return _as_report(totals, [(c.kind, name, c.column, f"c{i}") for i, c in enumerate(checks)])


def run_suite(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Check]],
              as_of: Column | None = None) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [run_checks(tables[name], name, checks, as_of) for name, checks in suite.items()])


def _as_report(totals: DataFrame, entries: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    lines = [F.struct(F.lit(kind).alias("check"), F.lit(name).alias("table_name"),
                      F.lit(column).alias("column_name"), F.col(total).alias("violations"))
             for kind, name, column, total in entries]
    return totals.select(F.inline(F.array(*lines)))


def raise_if_failed(report: DataFrame) -> None:
    """Fail loudly, naming every broken rule. The report holds one row per rule."""
    broken = report.filter(F.col("violations") > 0).collect()
    if broken:
        raise ValueError(f"{len(broken)} violation(s): " + "; ".join(
            f"{r['check']} {r['table_name']}.{r['column_name']} ({r['violations']})" for r in broken))


# The rules declared on the models.
MODEL_CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_alias": (unique("alias"), not_null("alias"), not_null("canonical_player_id")),
    "stg_match": (unique("match_id"), not_null("match_id"), not_null("player_id"), not_null("match_date"),
                  not_null("extraction_confidence"), in_range("first_serve_pct", 0, 1),
                  not_future("match_date")),
    "stg_training": (unique("session_id"), not_null("session_id"), not_null("player_id"),
                     not_null("session_date"), not_null("extraction_confidence"), in_range("shots_in", 0, 1)),
    "stg_student": (unique("student_id"), not_null("student_id"), not_null("preferred_name"),
                    accepted("dominant_hand", "right", "left"),
                    accepted("competition_level", "competitive", "recreational")),
    "match_strength": (unique("match_id"), not_null("match_id")),
    "daily_rollup": (not_null("player_id"), not_null("session_date")),
    "link_to_match": (not_null("player_id"), not_null("training_date")),
    "dim_player": (unique("player_sk"), not_null("player_sk"), not_null("player_id"), not_null("is_current")),
    "fct_match": (unique("match_sk"), not_null("match_sk"), unique("match_id"), not_null("match_id"),
                  not_null("player_id"), not_null("match_date")),
    "fct_training": (unique("session_sk"), not_null("session_sk"), not_null("player_id"),
                     not_null("session_date")),
    "development_score": (not_null("player_id"), not_null("score_week"), not_null("development_score")),
    "weekly_digest": (unique("digest_id"), not_null("digest_id"),
                      accepted("score_trend", "improving", "declining", "stable")),
    "monthly_report": (unique("report_id"), not_null("report_id"), not_null("player_id"),
                       not_null("report_month")),
}


def check_freshness(df: DataFrame, loaded_at: str, now: Column, warn_hours: float = 24,
                    error_hours: float = 48) -> DataFrame:
    """Age of the newest row against the limits; an empty table is an error."""
    age = (F.unix_micros(now) - F.unix_micros(F.col("loaded_at"))) / 3_600_000_000
    return (df.agg(F.max(F.col(loaded_at).try_cast("timestamp")).alias("loaded_at"))
            .withColumn("age_hours", F.round(age, 2))
            .withColumn("status", F.when(age.isNull() | (age > error_hours), "error")
                        .when(age > warn_hours, "warn").otherwise("pass")))


def check_idempotent(df: DataFrame, key: str) -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("unique_ids"))
            .withColumn("idempotent", F.col("total_rows") == F.col("unique_ids")))


def validate_contract(df: DataFrame | None, contract: Mapping[str, Any], spark: SparkSession,
                      now: Column | None = None) -> DataFrame:
    """Contract report of one table: existence, volume, columns, types, nulls, freshness.

    Row counts, null counts and the newest load time come out of one aggregate over the columns the
    contract names.
    """
    name, sla, specs = contract["name"], contract.get("sla", {}), contract.get("schema", [])
    if df is None:
        return spark.createDataFrame([("table_exists", name, "", 1)], REPORT)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    missing = [s["name"] for s in specs if s["name"] not in types]
    wrong = [s["name"] for s in specs if s["name"] in types and types[s["name"]] != s["type"].lower()]
    required = [s["name"] for s in specs if s["name"] in types and not s.get("nullable", True)]

    rows = F.count(F.lit(1))
    measures = {"min_rows": (rows < sla.get("min_rows", 1)).cast("bigint"),
                **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in required}}
    if now is not None and "freshness_error_hours" in sla and "_ingested_at" in types:
        oldest = now - F.make_interval(hours=F.lit(int(sla["freshness_error_hours"])))
        newest = F.max(F.col("_ingested_at").try_cast("timestamp"))
        measures["freshness"] = F.coalesce(newest < oldest, F.lit(True)).cast("bigint")
    for kind, columns in (("missing_column", missing), ("wrong_type", wrong)):
        measures.update({f"{kind}_{c}": F.lit(1).cast("bigint") for c in columns})

    entries = [("min_rows", name, "", "min_rows")]
    entries += [("missing_column", name, c, f"missing_column_{c}") for c in missing]
    entries += [("wrong_type", name, c, f"wrong_type_{c}") for c in wrong]
    entries += [("null_violation", name, c, f"null_{c}") for c in required]
    if "freshness" in measures:
        entries.append(("freshness", name, "_ingested_at", "freshness"))
    totals = df.agg(*[m.alias(alias) for alias, m in measures.items()])
    return _as_report(totals, entries)


def validate_contracts(spark: SparkSession, contracts: Iterable[Mapping[str, Any]], prefix: str = "",
                       now: Column | None = None) -> DataFrame:
    """Report over several contracts; ``prefix`` is a catalog schema or a folder."""
    reports = []
    for contract in contracts:
        target = f"{prefix}{contract['name']}"
        df = table(spark, target) if table_exists(spark, target) else None
        reports.append(validate_contract(df, contract, spark, now))
    return reduce(DataFrame.unionByName, reports)


def extraction_accuracy(approved: DataFrame, extracted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of approved sessions whose extracted sentiment is the approved one."""
    joined = approved.select("session_id", F.col("sentiment").alias("approved_sentiment"), *by).join(
        extracted.select(F.col("event_id").alias("session_id"), F.col("sentiment").alias("found_sentiment")),
        "session_id")
    return match_accuracy(joined, "approved_sentiment", "found_sentiment", by)


def daily_volume(df: DataFrame, name: str | Column, loaded_at: str) -> DataFrame:
    """Rows per day of one table, or, with a column for ``name``, of every table stacked in ``df``."""
    table = F.lit(name) if isinstance(name, str) else name
    return (df.groupBy(table.alias("table_name"), F.to_date(loaded_at).alias("day"))
            .agg(F.count(F.lit(1)).alias("rows")))


def volume_monitor(daily: DataFrame, days: int = 7, tolerance: float = 3.0) -> DataFrame:
    """Daily volume of each table against the mean and deviation of the ``days`` loads before it.

    A table with a shorter history is not judged.
    """
    before = Window.partitionBy("table_name").orderBy("day").rowsBetween(-days, -1)
    usual = F.avg("rows").over(before)
    deviation = F.stddev_pop("rows").over(before)
    return daily.withColumns({
        "usual_rows": F.round(usual, 2),
        "deviation": F.round(deviation, 2),
        "unusual": (F.count("rows").over(before) == days)
        & F.coalesce(F.abs(F.col("rows") - usual) > tolerance * deviation, F.lit(False)),
    })
