from __future__ import annotations

import datetime as dt
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import as_set
from podium.plans import audit, extraction
from podium.schemas import EXTRACTION_FAILURES, FINDINGS, NOTE_EXTRACTIONS, RAW_MATCHES, RAW_TRAINING
from podium.sources.readers import rows_to_df, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])



def now():
    return F.lit(dt.datetime(2024, 4, 1)).cast("timestamp")


def queue(spark, *sessions):
    rows = [(sid, "yi", dt.date(2024, 3, 1), "1400", kind, n, f"/raw/{sid}_{n}.png")
            for sid, kind, pages in sessions for n in range(1, pages + 1)]
    files = spark.createDataFrame(rows, "session_id string, player_name string, session_date date, session_time string, "
                                        "session_type string, page_number int, _source_file string")
    none = spark.createDataFrame([], "match_id string"), spark.createDataFrame([], "session_id string")
    return extraction.pending_sessions(files, *none)


def payload(**more):
    return {"pages_processed": 1, "stats": {}, "coaching_notes": None, "confidence": 0.9, **more}


def test_pending_excludes_both_targets(spark):
    files = spark.createDataFrame([(s, "p", None, "", "match", 1, s) for s in "abc"],
                                  "session_id string, player_name string, session_date date, session_time string, "
                                  "session_type string, page_number int, _source_file string")
    matches = spark.createDataFrame([("a",)], "match_id string")
    training = spark.createDataFrame([("b",), (None,)], "session_id string")
    assert as_set(extraction.pending_sessions(files, matches, training), "session_id") == {("c",)}


def test_retries_then_dead_letter(spark):
    def flaky(session):
        if session["session_id"] == "bad":
            raise RuntimeError("no answer")
        if session["session_id"] == "text":
            return "sorry, I cannot"
        return json.dumps(payload())

    results = {r["session_id"]: r for r in extraction.extract(
        queue(spark, ("ok", "match", 2), ("bad", "match", 1), ("text", "training", 1)), flaky).collect()}
    assert (results["ok"]["error"], results["ok"]["attempts"]) == (None, 1)
    assert (results["bad"]["error"], results["bad"]["attempts"]) == ("RuntimeError: no answer", 4)
    assert results["text"]["error"].startswith("JSONDecodeError")


def test_recovery_counts_attempts(spark):
    def second_time_lucky(session, seen={}):
        seen[session["session_id"]] = seen.get(session["session_id"], 0) + 1
        if seen[session["session_id"]] == 1:
            raise TimeoutError("slow")
        return "```json\n" + json.dumps(payload()) + "\n```"

    r = extraction.extract(queue(spark, ("s", "match", 1)), second_time_lucky).first()
    assert (r["attempts"], r["error"], json.loads(r["raw_text"])["confidence"]) == (2, None, 0.9)


@pytest.fixture
def run(spark, tmp_path):
    def read(session):
        if session["session_id"] == "lost":
            raise ValueError("unreadable")
        assert session["file_paths"] == sorted(session["file_paths"])
        if session["session_type"] == "match":
            return json.dumps(payload(stats={"winners": 7, "player_won": True, "aces": "many"},
                                      coaching_notes={"raw_note_text": "good", "sentiment": "improving"}))
        return json.dumps({"stats": {"shots_in": 0.7}})

    targets = {n: str(tmp_path / n) for n in ("matches", "training", "failures", "notes")}

    def go(name):
        sessions = queue(spark, ("m", "match", 3), ("t", "training", 1), ("lost", "match", 1))
        extraction.run_extraction(sessions, read, str(tmp_path / name), targets["matches"], targets["training"],
                                  targets["failures"], targets["notes"], calls_in_parallel=2, now=now())
        return {n: table(spark, target) for n, target in targets.items()}
    return go


def test_run_routes_every_session(run):
    out = run("first")
    assert out["matches"].columns == RAW_MATCHES.names and out["training"].columns == RAW_TRAINING.names
    m, t = out["matches"].first(), out["training"].first()
    assert (m["match_id"], m["winners"], m["player_won"], m["aces"], m["raw_note_text"]) == ("m", 7, True, None, "good")
    assert (t["session_id"], t["shots_in"], t["extraction_confidence"], t["prompt_version"]) == ("t", 0.7, 0.0, "v1.0")
    f = out["failures"].first()
    assert out["failures"].columns == EXTRACTION_FAILURES.names
    assert (f["failure_id"], f["error_message"], f["retry_count"]) == ("fail_lost", "ValueError: unreadable", 3)
    assert out["notes"].columns == NOTE_EXTRACTIONS.names
    assert as_set(out["notes"], "event_id", "event_type", "sentiment") == {("m", "match", "improving")}


def test_run_twice_keeps_earlier_rows(run):
    run("first")
    out = run("second")
    assert (out["matches"].count(), out["training"].count()) == (1, 1)


def test_parts_of_a_long_session_are_merged(spark):
    def read(session):
        first = session["part"] == 0
        return json.dumps(payload(pages_processed=len(session["file_paths"]), confidence=0.9 if first else 0.6,
                                  stats={"winners": 5} if first else {"winners": 9, "aces": 2}))

    sessions = extraction.pending_sessions(
        spark.createDataFrame([("s", "yi", dt.date(2024, 3, 1), "1400", "match", n, f"p{n:02d}") for n in range(1, 8)],
                              "session_id string, player_name string, session_date date, session_time string, "
                              "session_type string, page_number int, _source_file string"),
        spark.createDataFrame([], "match_id string"), spark.createDataFrame([], "session_id string"), chunk=5)
    assert sessions.count() == 2
    m = extraction.split_results(extraction.extract(sessions, read), "v1.0", now()).matches.first()
    assert (m["winners"], m["aces"], m["pages_processed"], m["extraction_confidence"]) == (5, 2, 7, 0.6)


def test_session_with_a_failed_part_stays_pending(spark, tmp_path):
    def read(session, broken):
        if broken and session["part"] == 1:
            raise ValueError("unreadable")
        return json.dumps(payload(pages_processed=len(session["file_paths"])))

    files = spark.createDataFrame(
        [(s, "yi", dt.date(2024, 3, 1), "1400", "match", n, f"{s}{n:02d}") for s, pages in (("long", 7), ("short", 2))
         for n in range(1, pages + 1)],
        "session_id string, player_name string, session_date date, session_time string, session_type string, "
        "page_number int, _source_file string")
    targets = [str(tmp_path / n) for n in ("matches", "training", "failures", "notes")]
    trained = spark.createDataFrame([], "session_id string")

    def go(name, done, broken):
        sessions = extraction.pending_sessions(files, done, trained, chunk=5)
        extraction.run_extraction(sessions, lambda s: read(s, broken), str(tmp_path / name), *targets, now=now())
        return table(spark, targets[0]), table(spark, targets[2])

    nothing = spark.createDataFrame([], "match_id string")
    for attempt in ("first", "replay"):
        matches, failures = go(attempt, nothing, True)
        assert as_set(matches, "match_id", "pages_processed") == {("short", 2)}
        assert [r["failure_id"] for r in failures.collect()] == ["fail_long"]
    matches, failures = go("later", matches, False)
    assert as_set(matches, "match_id", "pages_processed") == {("short", 2), ("long", 7)}
    assert failures.count() == 1


def noted(spark):
    matches = rows_to_df(spark, [
        {"match_id": "m1", "player_id": "a", "match_date": dt.date(2024, 1, 1), "raw_note_text": "perfect", "winners": 1,
         "first_serves_in": 0, "first_serves_total": 4, "break_points_won": 1, "break_points_total": 3},
        {"match_id": "m2", "raw_note_text": None}], RAW_MATCHES)
    training = rows_to_df(spark, [
        {"session_id": "t1", "raw_note_text": "poor", "shots_in": 0.914, "forehand_cross_court_in": 0.0},
        {"session_id": "t2", "raw_note_text": "fails", "shots_in": 0.5}], RAW_TRAINING)
    return matches, training


def test_audit_context_hides_zero_and_absent(spark):
    matches, training = noted(spark)
    assert audit.audit_context(matches, "match").first()["statistics"] == (
        "- Winners: 1\n- Unforced errors: N/A\n- First serve %: N/A\n- Break point conversion: 0.33")
    assert audit.audit_context(training, "training").first()["statistics"] == (
        "- Overall shots in: 0.91\n- Forehand cross-court accuracy: N/A\n- Backhand cross-court accuracy: N/A")


def judge(note, statistics):
    if note == "fails":
        raise RuntimeError("no answer")
    return {"has_inconsistency": note == "poor", "inconsistency_type": "UNDERSTATEMENT", "severity": "high"}


def test_audit_keeps_positive_findings_only(spark):
    found = audit.run_audit(*noted(spark), judge, now=now())
    assert found.columns == FINDINGS.names
    assert as_set(found, "session_id", "session_type", "severity", "coach_status") == {("t1", "training", "high", "pending")}


def test_audit_skips_sessions_with_a_finding(spark):
    first = audit.run_audit(*noted(spark), judge, now=now())
    assert audit.run_audit(*noted(spark), judge, existing=first, now=now()).count() == 0


def test_audit_error_is_kept_as_no_inconsistency(spark):
    cases = audit.audit_context(noted(spark)[1], "training")
    verdicts = {r["session_id"]: r for r in audit.audit(cases, judge).collect()}
    assert (verdicts["t2"]["has_inconsistency"], verdicts["t2"]["error"]) == (False, "RuntimeError: no answer")
