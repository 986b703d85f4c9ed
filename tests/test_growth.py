"""What a step costs as its tables grow: sides joined by their rows, not by the size of their files, and work done once."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from podium.operators import joins
from podium.plans import extraction, marts, refresh
from podium.schemas import RAW_MATCHES, RAW_TRAINING
from podium.sources import key_index, sinks
from podium.sources.readers import rows_to_df, table


@pytest.fixture
def few(monkeypatch):
    """Sides count as large from 51 rows on."""
    monkeypatch.setattr(joins, "MANY", 50)


def months(spark, n, count=20):
    return spark.range(n).select("id", F.format_string("2024-%02d", F.col("id") % count + 1).alias("month"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_feed_is_not_broadcast(spark, tmp_path, few, monkeypatch):
    target, plans = str(tmp_path / "t"), []

    def spy(*args):
        plans.append(plan_of(joins.new_only(*args)))
        return joins.new_only(*args)

    monkeypatch.setattr(sinks, "new_only", spy)
    rows = months(spark, 2000)
    sinks.apply_changes(rows.withColumn("_deleted", F.lit(False)), target, ["id"], "month")
    feed = rows.filter("id % 2 = 0").withColumns({"month": F.lit("2025-01"), "_deleted": F.col("id") % 4 == 0})
    assert sinks.apply_changes(feed, target, ["id"], "month").count() == 1000
    assert plans and not any("Broadcast" in p for p in plans)
    assert "Broadcast" not in plan_of(key_index.holders(rows, target, ["id"]))
    assert "Broadcast" in plan_of(key_index.holders(rows.limit(5), target, ["id"]))
    left = as_set(table(spark, target).select("id", F.col("month").cast("string")))
    assert len(left) == 1500 and {m for i, m in left if i % 4 == 2} == {"2025-01"}


def test_unknown_keys_meet_no_entry(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.insert_new(months(spark, 20_000), target, ["id"], ["month"], ["month"], indexed=True)
    assert key_index.holders(spark.range(10 ** 6, 10 ** 6 + 100_000), target, ["id"]).count() == 0
    assert key_index.holders(spark.range(30_000), target, ["id"]).count() == 20_000


def test_the_index_is_asked_once(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.overwrite(months(spark, 2000), target, ["month"])
    found = key_index.stored_rows(spark.range(0, 4000, 500), target, ["id"], "month")
    assert not any(".keys/" in f for f in found.inputFiles())
    assert as_set(found, "id") == {(0,), (500,), (1000,), (1500,)}


def run(spark, tmp_path, broken, monkeypatch):
    """Two sessions of pages through one store; the pages come under two names. Returns what was routed."""
    seen = []
    insert = extraction.insert_new
    monkeypatch.setattr(extraction, "insert_new", lambda df, *a, **k: (seen.append(df), insert(df, *a, **k)))
    pages = spark.createDataFrame(
        [("s", name, dt.date(2024, 3, 1), "1400", "match", n, f"p{n}") for n in range(1, 9) for name in ("y", "z")],
        "session_id string, player_name string, session_date date, session_time string, session_type string, page_number int, _source_file string")

    def read(page):
        if broken and page["file_paths"] == ["p3"]:
            raise TimeoutError("no answer")
        return json.dumps({"pages_processed": 1, "confidence": 0.5, "stats": {"winners": 4}})

    queue = extraction.pending_pages(pages, spark.createDataFrame([], "match_id string"), spark.createDataFrame([], "session_id string"))
    extraction.run_extraction(queue, read, *[str(tmp_path / n) for n in ("answers", "matches", "training", "failures", "notes")],
                              retries=0, now=F.lit("2024-04-01").cast("timestamp"))
    monkeypatch.setattr(extraction, "insert_new", insert)
    return seen


def test_a_unit_is_asked_once(spark, tmp_path, monkeypatch):
    for broken in (True, False):
        run(spark, tmp_path, broken, monkeypatch)
    assert table(spark, str(tmp_path / "answers")).count() == 9
    assert as_set(table(spark, str(tmp_path / "matches")), "match_id", "player_id", "pages_processed", "winners") == {("s", "y", 8, 4)}


def test_answers_are_routed_without_the_store(spark, tmp_path, monkeypatch):
    routed = [*run(spark, tmp_path, True, monkeypatch), *run(spark, tmp_path, False, monkeypatch)]
    assert len(routed) == 8 and not any("/answers/" in f for df in routed for f in df.inputFiles())


def test_what_is_asked_goes_through_no_shuffle(spark, tmp_path, monkeypatch):
    kept, keep = [], extraction.materialize
    monkeypatch.setattr(extraction, "materialize", lambda df, *a: (kept.append((df.columns, plan_of(df))), keep(df, *a))[1])
    routed = [*run(spark, tmp_path, True, monkeypatch), *run(spark, tmp_path, False, monkeypatch)]
    assert len(kept) == 5  # answers and sessions of both runs, the queue of the second
    assert not any("asked" in columns or "sha2" in plan for columns, plan in kept)
    (known,) = [plan for _, plan in kept[-1:]]
    assert "Union" in known and "Window" not in known  # units are told apart once, before the queue is stored
    answers = table(spark, str(tmp_path / "answers"))
    assert answers.filter(F.col("asked") == F.sha2(F.to_json(F.struct("file_paths")), 256)).count() == answers.count() == 9
    assert len(routed) == 8


def test_a_refresh_broadcasts_no_large_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "MANY", 0)
    plans, replace = [], refresh.replace_grains
    monkeypatch.setattr(refresh, "replace_grains", lambda fresh, *a: (plans.append(plan_of(fresh)), replace(fresh, *a)))
    aliases = spark.createDataFrame([("x", "y", "z")], "alias string, canonical_player_id string, alias_source string")
    dim = spark.createDataFrame([("k", "a", True, None)], "player_sk string, player_id string, is_current boolean, valid_from timestamp")
    played = [{"match_id": f"m{i}", "player_id": "a", "match_date": dt.date(2024, 1, i), "player_won": True, "winners": 5,
               "unforced_errors": 3} for i in range(1, 9)]
    feed = rows_to_df(spark, played, RAW_MATCHES).withColumn("_deleted", F.lit(False))
    trained = rows_to_df(spark, [{"session_id": "t", "player_id": "a", "session_date": dt.date(2024, 1, 2), "shots_in": 0.5}], RAW_TRAINING)
    refresh.refresh(str(tmp_path), aliases, dim, feed, trained.withColumn("_deleted", F.lit(False)))
    assert len(plans) == 5 and not any("BroadcastHashJoin" in p for p in plans)


def test_rows_of_the_report_carry_the_sums_of_their_own_input(spark, rows):
    matches = rows("player_id string, match_date date, player_won boolean, first_serve_pct double, break_point_conversion double",
                   ("a", dt.date(2024, 1, 2), True, 0.5, None), (None, None, False, None, 0.25), ("b", None, None, 1.0, 1.0),
                   (None, dt.date(2024, 1, 9), True, None, None))
    training = rows("player_id string, session_date date, total_shots_per_hour double",
                    ("a", dt.date(2024, 1, 30), 10.0), ("a", dt.date(2024, 2, 1), 99.0), (None, None, 7.0), ("b", None, None), ("c", None, 1.0))
    scores = rows("player_id string, score_week date, development_score double",
                  ("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 8), 4.0), (None, None, 3.0), ("b", dt.date(2024, 1, 1), 2.0))
    report = marts.monthly_report(matches, training, scores)
    assert as_set(report, "player_id", "report_month", "matches_played", "matches_won", "avg_first_serve_pct", "sessions_completed",
                  "avg_shots_per_hour", "development_score", "score_range") == {
        ("a", "2024-01", 1, 1, 0.5, 1, 10.0, 2.5, 3.0), (None, None, 1, 0, None, 1, 7.0, 3.0, 0.0),
        ("b", None, 1, 0, 1.0, 1, None, None, None), (None, "2024-01", 1, 1, None, 0, None, None, None)}
    partial = [line for line in plan_of(report).splitlines() if "partial_" in line]
    assert partial and not any("first_serve_pct" in line and "total_shots_per_hour" in line for line in partial)


def test_the_long_report_joins_the_items_to_their_orders_once(spark):
    from workload import load
    report = load().QUERIES["long_monthly_report"](spark, "/root/testdata/sf0.001")
    assert plan_of(report).count("lineitem.parquet") == 0  # stored before score and report read it


def test_a_large_batch_of_a_stream_is_not_broadcast(spark, few, monkeypatch):
    from workload import loads
    from workload.tables import Tables
    plans = []

    def spy(module, name, side):
        build = getattr(module, name)

        def told(*args):
            joined = build(*args)
            if args[side] is not None and args[side].count() > 50:
                plans.append(plan_of(joined))
            return joined

        monkeypatch.setattr(module, name, told)

    spy(sinks, "new_only", 1)
    spy(sinks, "unseen", 1)
    spy(key_index, "holders", 0)
    spy(key_index, "stored_rows", 0)
    in_time, overdue = loads._in_time(Tables(spark, "/root/testdata/sf0.01"))
    assert len(plans) > 4 and not any("BroadcastHashJoin" in plan for plan in plans)
    assert in_time.count() > 50 and overdue.count() > 50
