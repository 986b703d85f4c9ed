"""Work queue, extraction run and audit, with deterministic stand-ins for the external calls."""

from __future__ import annotations

import hashlib
import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.plans import audit as auditing
from podium.plans import extraction
from podium.schemas import FINDINGS, RAW_MATCHES, RAW_TRAINING
from podium.session import scratch_dir
from podium.sources import readers, sinks
from podium.sources.readers import table
from workload.registry import query
from workload.sql import n, ratio, rnd, with_ctes
from workload.tables import Tables

# The functions run on workers that may not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A conversation is a session, its turns are the pages; one opened by the system is a match.
_PAGES = """
    SELECT concat('c', c.conv_id) AS session_id, concat('p', c.conv_id) AS player_name,
           DATE '2024-03-01' AS session_date, '1400' AS session_time,
           CASE WHEN o.opener = 'system' THEN 'match' ELSE 'training' END AS session_type,
           CAST(c.turn + 1 AS INTEGER) AS page_number, concat('turn-', c.turn, '.png') AS _source_file, c.text
    FROM {turns} c
    JOIN (SELECT conv_id, min_by(role, turn) AS opener FROM {turns} GROUP BY conv_id) o ON o.conv_id = c.conv_id"""
# Sessions done so far: those whose number is a labelled document.
_PENDING = f"""
    SELECT * FROM ({_PAGES.format(turns='conversations')}) WHERE session_id NOT IN (SELECT concat('c', doc_id) FROM labels)"""


def _pages(t: Tables) -> DataFrame:
    return t.spark.sql(_PAGES, turns=t.conversations)


def _done(t: Tables) -> tuple[DataFrame, DataFrame]:
    ids = F.concat(F.lit("c"), "doc_id")
    return (t.labels.filter("quality = 1").select(ids.alias("match_id")),
            t.labels.filter("quality = 0").select(ids.alias("session_id")))


@query(f"""
    SELECT session_id, player_name, session_date, session_time, session_type,
           CAST((page_number - 1) // 4 AS BIGINT) AS part, CAST(0 AS BIGINT) AS share,
           string_agg(_source_file, ' ' ORDER BY _source_file) AS pages, count(*) AS page_count
    FROM ({_PENDING}) GROUP BY ALL""")
def pending_sessions(t: Tables) -> DataFrame:
    """Queue of sessions not extracted yet; long sessions come in parts of four pages."""
    queue = extraction.pending_sessions(_pages(t), *_done(t), chunk=4)
    return queue.withColumn("file_paths", F.array_join("file_paths", " ")).withColumnRenamed("file_paths", "pages")


@query("SELECT DISTINCT concat('c', doc_id) AS session_id FROM labels")
def processed_sessions(t: Tables) -> DataFrame:
    return extraction.processed_sessions(*_done(t))


def read_text(session: dict) -> str:
    """Stand-in for the page reader: counts what it was given, and fails on some texts, whatever their length."""
    pages = session["file_paths"]
    size = sum(len(p) for p in pages)
    if hashlib.md5(min(pages).encode()).hexdigest()[0] == "0":
        raise ValueError(f"unreadable: {size} characters")
    kind = session["session_type"]
    stats = ({"winners": size, "unforced_errors": len(pages), "score": "6-4", "player_won": size % 2 == 1}
             if kind == "match" else
             {"shots_in": len(pages) / 8, "shots_per_hour": size, "longest_rally": "unknown"})
    payload = {"session_type": kind, "pages_processed": len(pages), "stats": stats, "confidence": 0.75,
               "coaching_notes": {"raw_note_text": min(pages), "sentiment": "improving"} if size % 3 else None}
    return f"```json\n{json.dumps(payload)}\n```"


_READ = f"""
    SELECT session_id, player_name, session_type, count(*) AS pages, {n('sum(length(text))')} AS size,
           min(text) AS first_text, md5(min(text))[1] = '0' AS unreadable
    FROM ({_PENDING}) GROUP BY ALL"""


def _extracted(t: Tables) -> dict[str, DataFrame]:
    # The text itself stands where a path would, so the reader needs no files.
    pages = _pages(t).drop("_source_file").withColumnRenamed("text", "_source_file")
    queue = extraction.pending_sessions(pages, *_done(t))
    targets = {name: scratch_dir(t.spark, name) for name in ("matches", "training", "failures", "notes")}
    extraction.run_extraction(
        queue, read_text, scratch_dir(t.spark, "answers"), targets["matches"], targets["training"],
        targets["failures"], targets["notes"], now=F.lit("2024-04-01").cast("timestamp"), pause=0.0)
    return {name: table(t.spark, target) for name, target in targets.items()}


@query(f"""
    SELECT session_id AS match_id, player_name AS player_id, size AS winners, pages AS unforced_errors,
           size % 2 = 1 AS player_won, CASE WHEN size % 3 <> 0 THEN first_text END AS raw_note_text,
           pages AS pages_processed, 0.75e0 AS extraction_confidence, CAST(NULL AS BIGINT) AS aces,
           'v1.0' AS prompt_version, TIMESTAMP '2024-04-01' AS _ingested_at
    FROM ({_READ}) WHERE session_type = 'match' AND NOT unreadable""")
def extracted_matches(t: Tables) -> DataFrame:
    return _extracted(t)["matches"].select(
        "match_id", "player_id", "winners", "unforced_errors", "player_won", "raw_note_text",
        "pages_processed", "extraction_confidence", "aces", "prompt_version", "_ingested_at")


@query(f"""
    SELECT session_id, player_name AS player_id, DATE '2024-03-01' AS session_date, 'training' AS session_type,
           pages / 8 AS shots_in, size AS shots_per_hour, CAST(NULL AS BIGINT) AS longest_rally,
           CASE WHEN size % 3 <> 0 THEN first_text END AS raw_note_text, pages AS pages_processed
    FROM ({_READ}) WHERE session_type = 'training' AND NOT unreadable""")
def extracted_training(t: Tables) -> DataFrame:
    return _extracted(t)["training"].select(
        "session_id", "player_id", "session_date", "session_type", "shots_in", "shots_per_hour",
        "longest_rally", "raw_note_text", "pages_processed")


@query(f"""
    SELECT 'fail_' || session_id AS failure_id, session_id AS source_file, 'extraction_failed' AS error_reason,
           'ValueError: unreadable: ' || size || ' characters' AS error_message, 3 AS retry_count,
           'v1.0' AS pipeline_version, TIMESTAMP '2024-04-01' AS failed_at
    FROM ({_READ}) WHERE unreadable""")
def extraction_failures(t: Tables) -> DataFrame:
    """Dead letters: four attempts each, the error kept as data."""
    return _extracted(t)["failures"]


@query(f"""
    SELECT session_id AS event_id, session_type AS event_type, player_name AS player_id, 'improving' AS sentiment
    FROM ({_READ}) WHERE NOT unreadable AND size % 3 <> 0""")
def extracted_notes(t: Tables) -> DataFrame:
    return _extracted(t)["notes"].select("event_id", "event_type", "player_id", "sentiment")


# A supplier's shipped line items are the pages of a session: hundreds for one supplier, few for another.
_PAGE_ROWS = """
    SELECT concat('s', l_suppkey) AS session_id, concat('p', l_suppkey) AS player_name, DATE '2024-03-01' AS session_date,
           '1400' AS session_time, CASE WHEN l_suppkey % 2 = 0 THEN 'match' ELSE 'training' END AS session_type,
           CAST(dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_returnflag) AS INTEGER) AS page_number,
           concat(l_orderkey, '-', l_linenumber, '-', CAST(l_quantity AS BIGINT), '-', l_returnflag) AS _source_file
    FROM {lines} WHERE l_suppkey % 3 = 0 OR l_shipdate < TIMESTAMP '1994-02-01'"""


def read_page(session: dict) -> str:
    """Stand-in for the reader of one page: returned items show their quantity, the others only that they were read."""
    (page,) = session["file_paths"]
    order, line, quantity, flag = page.split("-")
    if flag == "N" and int(order) % 997 == 0:
        raise ValueError(f"unreadable: {page}")
    known = {"winners": int(quantity), "shots_per_hour": int(quantity)} if flag == "R" else {}
    return json.dumps({"session_type": session["session_type"], "pages_processed": 1, "stats": known,
                       "confidence": int(quantity) / 64})


def _read_by_pages(t: Tables, runs: int) -> tuple[dict[str, DataFrame], str]:
    """``runs`` runs over one store of answers; the first has a reader that loses every seventh order."""
    pages = sinks.materialize(t.spark.sql(_PAGE_ROWS, lines=t.lineitem), scratch_dir(t.spark, "pages"))
    store = scratch_dir(t.spark, "answers")
    targets = {name: scratch_dir(t.spark, name) for name in ("matches", "training", "failures", "notes")}

    def first_reader(session: dict) -> str:
        if int(session["file_paths"][0].split("-")[0]) % 7 == 0:
            raise TimeoutError("no answer")
        return read_page(session)

    for run in range(runs):
        done = [readers.table_or_empty(t.spark, targets[name], schema)
                for name, schema in (("matches", RAW_MATCHES), ("training", RAW_TRAINING))]
        queue = extraction.pending_pages(pages, *done)
        extraction.run_extraction(
            queue, first_reader if run < runs - 1 else read_page, store, targets["matches"], targets["training"],
            targets["failures"], targets["notes"], retries=0, now=F.lit(f"2024-04-0{run + 1}").cast("timestamp"))
    return {name: table(t.spark, targets[name]) for name in ("matches", "training")}, store


_PAGES_READ = f"""
    SELECT *, l_returnflag = 'N' AND l_orderkey % 997 = 0 AS bad
    FROM (SELECT DISTINCT *, CAST(split_part(_source_file, '-', 1) AS BIGINT) AS l_orderkey, split_part(_source_file, '-', 4) AS l_returnflag,
                 CAST(split_part(_source_file, '-', 3) AS BIGINT) AS quantity
          FROM ({_PAGE_ROWS.format(lines='lineitem')}))"""


@query(f"""
    SELECT session_id, player_name AS player_id, session_type,
           min_by(quantity, page_number) FILTER (l_returnflag = 'R') AS first_quantity,
           count(*) AS pages_processed, min(quantity) / 64 AS extraction_confidence
    FROM ({_PAGES_READ}) GROUP BY ALL HAVING NOT bool_or(bad)""")
def extracted_by_page(t: Tables) -> DataFrame:
    """Sessions of a few to hundreds of pages, read page by page in two runs and merged."""
    found, _ = _read_by_pages(t, 2)
    same = ("player_id", "session_type", "pages_processed", "extraction_confidence")
    return (found["matches"].select(F.col("match_id").alias("session_id"), F.lit("match").alias("session_type"), "player_id",
                                    F.col("winners").alias("first_quantity"), "pages_processed", "extraction_confidence")
            .unionByName(found["training"].select("session_id", F.col("shots_per_hour").alias("first_quantity"), *same)))


@query(f"""
    SELECT session_id, count(*) AS units, count(*) + count(*) FILTER (l_orderkey % 7 = 0 OR bad) AS calls
    FROM ({_PAGES_READ}) GROUP BY ALL""")
def calls_of_a_rerun(t: Tables) -> DataFrame:
    """Calls made in two runs: the second asks for the pages only that had no answer."""
    _, store = _read_by_pages(t, 2)
    return table(t.spark, store).groupBy("session_id").agg(
        F.count_distinct("part", "share").alias("units"), F.count(F.lit(1)).alias("calls"))


def _figure(x: str) -> str:
    return f"CASE WHEN {x} <> 0 THEN CAST({x} AS VARCHAR) ELSE 'N/A' END"


_CASES = f"""
    SELECT match_id AS session_id, 'match' AS session_type, player_id, match_date AS session_date, raw_note_text,
           '- Winners: ' || coalesce(CAST(winners AS VARCHAR), 'N/A') || chr(10) ||
           '- Unforced errors: ' || coalesce(CAST(unforced_errors AS VARCHAR), 'N/A') || chr(10) ||
           '- First serve %: ' || {_figure(f"({ratio('first_serves_in', 'first_serves_total', 2)})")} || chr(10) ||
           '- Break point conversion: ' || {_figure(f"({ratio('break_points_won', 'break_points_total', 2)})")} AS statistics
    FROM raw_match WHERE raw_note_text IS NOT NULL
    UNION ALL
    SELECT session_id, 'training', player_id, session_date, raw_note_text,
           '- Overall shots in: ' || {_figure(rnd('shots_in', 2))} || chr(10) ||
           '- Forehand cross-court accuracy: ' || {_figure(rnd('forehand_cross_court_in', 2))} || chr(10) ||
           '- Backhand cross-court accuracy: ' || {_figure(rnd('backhand_cross_court_in', 2))}
    FROM raw_training WHERE raw_note_text IS NOT NULL"""


@query(with_ctes(_CASES, "raw_match", "raw_training"))
def audit_context(t: Tables) -> DataFrame:
    return auditing.audit_context(t.raw_matches, "match").unionByName(
        auditing.audit_context(t.raw_training, "training"))


def rule_judge(note: str, statistics: str) -> dict:
    """Stand-in for the judge: a lost match with every first serve in is suspicious."""
    if "Winners: 13\n" in statistics:
        raise RuntimeError("no answer")
    if note.startswith("error") and "First serve %: 1.0" in statistics:
        return {"has_inconsistency": True, "inconsistency_type": "PERFORMANCE_CONTRADICTION", "severity": "high",
                "description": "all first serves in", "note_excerpt": note, "stat_evidence": "First serve %: 1.0"}
    if "N/A" in statistics and "shots in" in statistics:
        return {"has_inconsistency": True, "inconsistency_type": "MISSING_CONTEXT", "severity": "low",
                "note_excerpt": note}
    return {"has_inconsistency": False}


@query(with_ctes(f"""
    SELECT sha256(session_type || '|' || session_id) AS finding_id, session_id, session_type, player_id,
           session_date, CASE WHEN lost THEN 'PERFORMANCE_CONTRADICTION' ELSE 'MISSING_CONTEXT' END AS inconsistency_type,
           CASE WHEN lost THEN 'high' ELSE 'low' END AS severity,
           CASE WHEN lost THEN 'all first serves in' END AS description, raw_note_text AS note_excerpt,
           CASE WHEN lost THEN 'First serve %: 1.0' END AS stat_evidence, 'pending' AS coach_status,
           TIMESTAMP '2024-04-01' AS audited_at
    FROM (SELECT *, starts_with(raw_note_text, 'error') AND contains(statistics, 'First serve %: 1.0') AS lost,
                 contains(statistics, 'N/A') AND contains(statistics, 'shots in') AS missing
          FROM ({_CASES}) WHERE NOT contains(statistics, 'Winners: 13' || chr(10)))
    WHERE (lost OR missing) AND session_id NOT IN (SELECT concat('m', doc_id) FROM labels)""",
    "raw_match", "raw_training"))
def audit_findings(t: Tables) -> DataFrame:
    """Open findings, none for sessions that have one already; a failing call finds nothing."""
    known = t.labels.select(F.concat(F.lit("m"), "doc_id").alias("session_id"))
    return auditing.run_audit(t.raw_matches, t.raw_training, rule_judge, known,
                              F.lit("2024-04-01").cast("timestamp")).select(*FINDINGS.names)


@query(with_ctes(f"""
    SELECT session_type, session_id, failed AS error, TIMESTAMP '2024-04-01' AS audited_at FROM (
        SELECT *, CASE WHEN contains(statistics, 'Winners: 13' || chr(10)) THEN 'RuntimeError: no answer' END AS failed
        FROM ({_CASES}))
    UNION ALL
    SELECT session_type, session_id, 'RuntimeError: no answer', TIMESTAMP '2024-04-02'
    FROM ({_CASES}) WHERE contains(statistics, 'Winners: 13' || chr(10))""", "raw_match", "raw_training"))
def audit_verdicts(t: Tables) -> DataFrame:
    """Two runs: the second judges those sessions only whose call had failed."""
    verdicts, findings = scratch_dir(t.spark, "verdicts"), scratch_dir(t.spark, "findings")
    for day in ("2024-04-01", "2024-04-02"):
        auditing.store_audit(t.raw_matches, t.raw_training, rule_judge, verdicts, findings,
                             now=F.lit(day).cast("timestamp"))
    return table(t.spark, verdicts).select("session_type", "session_id", "error", "audited_at")
