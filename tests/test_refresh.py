"""Change feeds, the key index and pruned rewrites: results, and what is read and written for them."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import as_set
from podium.operators.windows import global_rank
from podium.plans import build, extraction, refresh
from podium.schemas import RAW_MATCHES, RAW_TRAINING
from podium.sources import key_index, sinks
from podium.sources.readers import rows_to_df, table

ROWS = "id bigint, value string, month string"


def stamps(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


def months(spark, n=2000, count=20):
    return spark.range(n).select("id", F.concat(F.lit("v"), "id").alias("value"),
                                 F.concat(F.lit("2024-"), F.lpad((F.col("id") % count + 1).cast("string"), 2, "0")).alias("month"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_named_partitions_prune_the_scan(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.overwrite(months(spark), target, ["month"])
    cut = key_index.in_partitions(table(spark, target), "month", ["2024-03", "2024-07"])
    assert "PartitionFilters: [month" in plan_of(cut).replace("isnotnull(month", "month")
    assert {f.split("month=")[1].split("/")[0] for f in cut.inputFiles()} <= {f"2024-{i:02d}" for i in range(1, 21)}
    assert cut.count() == 200
    assert key_index.in_partitions(table(spark, target), "month", []).count() == 0


def test_upsert_leaves_other_partitions_alone(spark, tmp_path, rows):
    target = str(tmp_path / "t")
    sinks.overwrite(months(spark), target, ["month"])
    before = stamps(target)
    sinks.upsert_partitions(rows(ROWS, (2, "new", "2024-03"), (9003, "added", "2024-03")), target, ["id"], "month")
    after = stamps(target)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "month=2024-03" in f}
    assert as_set(table(spark, target).filter("id IN (2, 22, 9003)"), "id", "value") == {(2, "new"), (22, "v22"), (9003, "added")}
    assert table(spark, target).count() == 2001


def test_a_deleted_partition_is_gone(spark, tmp_path, rows):
    target = str(tmp_path / "t")
    sinks.overwrite(rows(ROWS, (1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", None), (4, "d", None)), target, ["month"])
    gone = rows(ROWS + ", gone boolean", (2, None, "2024-02", True), (3, None, None, True), (1, "z", "2024-01", None))
    sinks.upsert_partitions(gone, target, ["id"], "month", deleted="gone")
    assert as_set(table(spark, target), "id", "value") == {(1, "z"), (4, "d")}
    assert not os.path.exists(f"{target}/month=2024-02")
    sinks.upsert_partitions(rows(ROWS + ", gone boolean", (4, None, None, True)), target, ["id"], "month", deleted="gone")
    assert as_set(table(spark, target), "id", "value") == {(1, "z")}


def test_catalog_table_loses_an_emptied_partition(spark, rows):
    spark.sql("DROP TABLE IF EXISTS feed_target")
    try:
        sinks.overwrite(rows(ROWS, (1, "a", "2024-01"), (2, "b", "2024-02")), "feed_target", ["month"])
        sinks.upsert_partitions(rows(ROWS + ", gone boolean", (2, None, "2024-02", True)), "feed_target", ["id"], "month", deleted="gone")
        assert as_set(spark.table("feed_target"), "id", "value") == {(1, "a")}
    finally:
        spark.sql("DROP TABLE IF EXISTS feed_target")


def test_changes_move_delete_and_report_what_stood_before(spark, tmp_path, rows):
    target, schema = str(tmp_path / "t"), ROWS + ", _deleted boolean"
    sinks.apply_changes(rows(schema, (1, "a", "2024-01", False), (2, "b", "2024-01", False), (3, "c", "2024-02", None)), target, ["id"], "month")
    untouched = {f: s for f, s in stamps(target).items() if "2024-02" in f}
    before = sinks.apply_changes(rows(schema, (1, "A", "2024-03", False), (2, None, None, True), (8, None, None, True)), target, ["id"], "month")
    assert as_set(before.select("id", "value", F.col("month").cast("string"))) == {(1, "a", "2024-01"), (2, "b", "2024-01")}
    assert as_set(table(spark, target).select("id", "value", F.col("month").cast("string"))) == {(1, "A", "2024-03"), (3, "c", "2024-02")}
    assert untouched.items() <= stamps(target).items()


def test_key_index_bounds_what_is_read(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.insert_new(months(spark, 40_000), target, ["id"], ["value"], ["month"], indexed=True)
    asked = spark.createDataFrame([(5,), (45,), (-1,), (10 ** 12,)], "id bigint")  # 5 and 45 lie in month 6
    found = key_index.stored_rows(asked, target, ["id"], "month")
    assert as_set(found, "id") == {(5,), (45,)}
    scanned = {f.split("month=")[1].split("/")[0] for f in key_index.in_partitions(
        table(spark, target), "month", key_index.partitions_of(key_index.holders(asked, target, ["id"]), "_partition")).inputFiles()}
    assert "2024-06" in scanned
    assert "PartitionFilters: [" in plan_of(found) and "PartitionFilters: []" not in plan_of(found).split("keys")[0].split("month#")[0]
    unknown = spark.range(10 ** 6, 10 ** 6 + 20_000).select("id")
    assert key_index.holders(unknown, target, ["id"]).count() < 20_000 * 20 * 0.001


def test_index_names_every_holder(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = months(spark, 5000)
    sinks.overwrite(rows, target, ["month"])
    key_index.ensure(rows, target, ["id"], "month")
    named = key_index.holders(rows, target, ["id"])
    assert rows.join(named, (rows.id == named.id) & (rows.month == named._partition), "left_anti").count() == 0


def test_replay_through_the_index_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    for load in (months(spark, 300), months(spark, 500), months(spark, 500).unionByName(months(spark, 500))):
        sinks.insert_new(load, target, ["id"], ["value"], ["month"], indexed=True)
    assert (table(spark, target).count(), table(spark, target).distinct().count()) == (500, 500)


def match(i, day, won=True, player="a"):
    return {"match_id": f"m{i}", "player_id": player, "match_date": day, "player_won": won, "winners": 5, "unforced_errors": 3,
            "break_points_won": i, "break_points_total": i + 3}


def session(i, day, player="a"):
    return {"session_id": f"t{i}", "player_id": player, "session_date": day, "shots_in": 0.5, "shots_per_hour": 100 + i}


def test_refresh_equals_a_build_and_touches_little(spark, tmp_path):
    folder = str(tmp_path)
    aliases = spark.createDataFrame([], "alias string, canonical_player_id string, alias_source string")
    dim = spark.createDataFrame([], "player_sk string, player_id string, is_current boolean, valid_from timestamp")
    jan, mar, feb = dt.date(2024, 1, 10), dt.date(2024, 3, 5), dt.date(2024, 2, 29)
    matches = [match(1, jan), match(2, mar), match(3, mar, player="b"), match(4, feb, False), match(5, dt.date(2024, 5, 1), player="b")]
    sessions = [session(1, jan), session(2, dt.date(2024, 1, 11)), session(3, mar, "b"), session(4, dt.date(2024, 5, 2), "b")]

    def feed(rows, schema, deleted=()):
        df = rows_to_df(spark, rows, schema)
        key = schema.names[0] if schema is not RAW_TRAINING else "session_id"
        return df.withColumn("_deleted", F.col(key).isin(list(deleted)) if deleted else F.lit(False))

    refresh.refresh(folder, aliases, dim, feed(matches, RAW_MATCHES), feed(sessions, RAW_TRAINING))
    before = stamps(f"{folder}/monthly_report") | stamps(f"{folder}/fct_match")
    moved, gone = match(2, feb), match(4, feb)
    after = refresh.refresh(folder, aliases, dim, feed([moved, gone], RAW_MATCHES, ["m4"]), feed([session(2, mar)], RAW_TRAINING))
    kept = stamps(f"{folder}/monthly_report") | stamps(f"{folder}/fct_match")
    assert all(kept[f] == s for f, s in before.items() if "2024-05" in f)  # no one touched May

    whole = str(tmp_path / "whole")
    now_matches = [match(1, jan), moved, match(3, mar, player="b"), match(5, dt.date(2024, 5, 1), player="b")]
    now_sessions = [session(1, jan), session(2, mar), session(3, mar, "b"), session(4, dt.date(2024, 5, 2), "b")]
    full = refresh.refresh(whole, aliases, dim, feed(now_matches, RAW_MATCHES), feed(now_sessions, RAW_TRAINING))
    for name in ("fct_match", "fct_training", "development_score", "weekly_digest", "monthly_report"):
        columns = [c for c in full[name].columns if c not in ("calculated_at", "_ingested_at")]
        assert as_set(after[name].select(columns)) == as_set(full[name].select(columns)), name
    assert full["monthly_report"].filter("player_id = 'a'").count() == 2


def test_build_removes_rows_that_are_gone(spark, tmp_path):
    target = str(tmp_path / "digest")
    score = spark.createDataFrame(
        [("a", None, dt.date(2024, 1, 1), 10.0), ("a", None, dt.date(2024, 1, 8), 12.0), ("b", None, dt.date(2024, 1, 1), 5.0)],
        "player_id string, player_sk string, score_week date, development_score double").selectExpr(
        "*", "1L AS matches_played", "1L AS matches_won", "0L AS sessions_completed", "0.0D AS avg_shots_per_hour")
    build.refresh_digest(score, target)
    left = build.refresh_digest(score.filter("player_id = 'a' AND score_week > '2024-01-01'"), target)
    assert [(r.player_id, r.development_score, r.score_change) for r in left.collect()] == [("a", 12.0, None)]


def test_global_rank_of_ties_nulls_and_a_busy_value(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id % 1000) AS v", "if(id = 5, null, id) AS id")
    ranked = global_rank(df, ["v", F.col("id").desc_nulls_last()]).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 20_001))
    ordered = sorted(ranked, key=lambda r: r["rank"])
    assert [(r.v, r.id) for r in ordered] == sorted(((r.v, r.id) for r in ranked),
                                                    key=lambda x: (x[0], x[1] is None, -(x[1] or 0)))
    assert global_rank(df.limit(0), ["v"]).count() == 0


def test_good_answers_are_asked_for_once(spark, tmp_path):
    asked = str(tmp_path / "asked")
    os.makedirs(asked)
    files = spark.createDataFrame(
        [("s", "yi", dt.date(2024, 3, 1), "1400", "match", n, f"p{n:03d}") for n in range(1, 301)]
        + [("one", "yi", dt.date(2024, 3, 1), "1400", "match", 1, "q")],
        "session_id string, player_name string, session_date date, session_time string, session_type string, page_number int, _source_file string")
    targets = [str(tmp_path / n) for n in ("matches", "training", "failures", "notes")]
    nothing, trained = spark.createDataFrame([], "match_id string"), spark.createDataFrame([], "session_id string")

    def read(page, broken):
        (name,) = page["file_paths"]
        with open(f"{asked}/{name}", "a", encoding="utf-8") as f:
            f.write("x")
        if broken and name in ("p007", "p250"):
            raise TimeoutError("no answer")
        return json.dumps({"pages_processed": 1, "confidence": 0.5, "stats": {"winners": int(name[1:] or 0)}})

    for broken in (True, True, False):
        queue = extraction.pending_pages(files, nothing, trained)
        extraction.run_extraction(queue, lambda p, b=broken: read(p, b), str(tmp_path / "answers"), *targets, retries=0,
                                  now=F.lit("2024-04-01").cast("timestamp"))
    calls = {n: os.path.getsize(f"{asked}/{n}") for n in os.listdir(asked)}
    assert (calls.pop("p007"), calls.pop("p250")) == (3, 3) and set(calls.values()) == {1} and len(calls) == 299
    assert as_set(table(spark, targets[0]), "match_id", "pages_processed", "winners") == {("s", 300, 1), ("one", 1, 0)}
    assert table(spark, targets[2]).count() == 1
