from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from podium.plans import quality, review
from podium.schemas import FINDINGS, RAW_MATCHES, RAW_TRAINING
from podium.sources.readers import rows_to_df



def now():
    return F.lit(dt.datetime(2024, 2, 1, 12)).cast("timestamp")


def test_declared_rules():
    kinds = Counter(c.kind for checks in quality.MODEL_CHECKS.values() for c in checks)
    assert kinds == {"unique": 11, "not_null": 34, "accepted_values": 3, "range": 2, "not_future": 1}


def bad(rows):
    return rows("id string, v double, c string, d date",
                ("a", 0.5, "x", dt.date(2024, 1, 1)), ("a", 1.5, "y", dt.date(2024, 3, 1)), (None, None, None, None),
                (None, -0.1, "x", dt.date(2024, 2, 1)))


RULES = (quality.unique("id"), quality.not_null("id"), quality.in_range("v", 0, 1), quality.accepted("c", "x"),
         quality.not_future("d"))


def test_rules_count_violations(rows):
    report = quality.run_checks(bad(rows), "t", RULES, F.lit(dt.date(2024, 2, 1)))
    assert as_set(report, "check", "violations") == {
        ("unique", 1), ("not_null", 2), ("range", 2), ("accepted_values", 1), ("not_future", 1)}
    with pytest.raises(ValueError, match="5 violation"):
        quality.raise_if_failed(report)
    quality.raise_if_failed(report.filter("violations = 0"))


def test_report_agrees_with_the_failing_rows(rows):
    df, as_of = bad(rows), F.lit(dt.date(2024, 2, 1))
    report = {r["check"]: r["violations"] for r in quality.run_checks(df, "t", RULES, as_of).collect()}
    assert report == {c.kind: quality.failing_rows(df, c, as_of).count() for c in RULES}


@pytest.mark.parametrize("hours,status", [(1, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error"), (None, "error")])
def test_freshness(rows, hours, status):
    at = None if hours is None else dt.datetime(2024, 2, 1, 12) - dt.timedelta(hours=hours)
    assert quality.check_freshness(rows("t timestamp", (at,)), "t", now()).first()["status"] == status


CONTRACT = {"name": "t", "sla": {"min_rows": 3, "freshness_error_hours": 72},
            "schema": [{"name": "id", "type": "STRING", "nullable": False}, {"name": "n", "type": "BIGINT"},
                       {"name": "gone", "type": "DATE"}]}


def test_contract_lists_every_violation(spark, rows):
    df = rows("id string, n string, _ingested_at timestamp", ("a", "1", dt.datetime(2024, 1, 1)), (None, "2", None))
    report = quality.validate_contract(df, CONTRACT, spark, now())
    assert as_set(report.filter("violations > 0"), "check", "column_name", "violations") == {
        ("min_rows", "", 1), ("missing_column", "gone", 1), ("wrong_type", "n", 1), ("null_violation", "id", 1),
        ("freshness", "_ingested_at", 1)}


def test_contracts_are_judged_one_by_one(spark, tmp_path):
    from podium.sources.sinks import overwrite

    good = {"name": "good", "sla": {"min_rows": 1}, "schema": [{"name": "id", "type": "BIGINT", "nullable": False}]}
    overwrite(spark.range(2), f"{tmp_path}/good")
    report = quality.validate_contracts(spark, [{**CONTRACT, "name": "absent"}, good], f"{tmp_path}/")
    assert as_set(report.filter("violations > 0"), "check", "table_name") == {("table_exists", "absent")}


def test_idempotency_and_accuracy(rows):
    assert quality.check_idempotent(rows("k int", (1,), (1,)), "k").first()["idempotent"] is False
    approved = rows("session_id string, sentiment string, version string", ("a", "x", "1"), ("b", "y", "1"), ("c", "z", "2"))
    found = rows("event_id string, sentiment string", ("a", "x"), ("b", "x"))
    assert quality.extraction_accuracy(approved, found).first()["accuracy"] == 0.5
    assert as_set(quality.extraction_accuracy(approved, found, ["version"]), "version", "total") == {("1", 2)}


def test_volume_monitor(rows):
    days = [("t", dt.date(2024, 1, i), 100 + i % 2) for i in range(1, 8)] + [("t", dt.date(2024, 1, 8), 10)]
    unusual = quality.volume_monitor(rows("table_name string, day date, rows bigint", *days))
    assert as_set(unusual.filter("unusual"), "day") == {(dt.date(2024, 1, 8),)}


def test_review_queue(spark, rows):
    matches = rows_to_df(spark, [{"match_id": f"m{c}", "extraction_confidence": c, "winners": 3} for c in (0.5, 0.7, 0.8, None)], RAW_MATCHES)
    training = rows_to_df(spark, [{"session_id": "t", "extraction_confidence": 0.1}], RAW_TRAINING)
    reviewed = rows("session_id string", ("m0.7",), (None,))
    queue = review.review_queue(matches, training, reviewed)
    assert [(r["session_id"], r["confidence_band"], r["winners"]) for r in queue.collect()] == [("t", "low", None), ("m0.5", "low", 3)]
    assert review.review_queue(matches, training, reviewed, kind="match").count() == 1
    assert tuple(review.review_counts(queue, reviewed).first()) == (2, 2)


def findings(spark):
    return rows_to_df(spark, [
        {"finding_id": f"{i}", "severity": s, "coach_status": c, "audited_at": dt.datetime(2024, 1, 1 + i)}
        for i, (s, c) in enumerate([("low", "pending"), ("high", "pending"), (None, "pending"), ("medium", "confirmed"),
                                    ("high", "pending")])], FINDINGS)


def test_findings_order_and_kpis(spark):
    assert [r["finding_id"] for r in review.findings_view(findings(spark)).collect()] == ["4", "1", "2", "0"]
    assert [r["finding_id"] for r in review.findings_view(findings(spark), "All", "medium").collect()] == ["3"]
    assert tuple(review.finding_kpis(findings(spark)).first()) == (5, 2, 4, 1)
