"""Operators that work in one pass: what they read, and that they give what the longer way gives."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import as_set
from podium.operators import joins
from podium.plans import quality, review
from podium.schemas import declare
from podium.sources.readers import decode_or_reject


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_versions_are_looked_up_in_one_pass_over_the_facts(spark, tmp_path):
    spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'star', concat('p', id % 50)) AS player_id",
                                 "if(id = 7, null, date_add(DATE'2024-01-01', CAST(id % 300 AS INT))) AS d").write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    dim = spark.range(60).selectExpr(
        "concat('p', id % 20) AS player_id", "concat('v', id) AS player_sk",
        "CAST(date_add(DATE'2024-01-01', CAST(4 * id AS INT)) AS TIMESTAMP) AS valid_from",
        "if(id < 40, CAST(date_add(DATE'2024-01-01', CAST(4 * id + 60 AS INT)) AS TIMESTAMP), null) AS valid_to")
    got = joins.version_at(facts, dim, "player_id", "d")
    assert scans(got) == 1
    versions = [(r.player_id, r.player_sk, r.valid_from.date(), r.valid_to and r.valid_to.date()) for r in dim.collect()]
    for r in got.collect():
        begun = [v for v in versions if v[0] == r.player_id and r.d and v[2] <= r.d]
        last = max(begun, key=lambda v: v[2], default=None)
        assert r.player_sk == (last[1] if last and (last[3] is None or last[3] > r.d) else None)


def test_version_of_nulls(rows):
    facts = rows("player_id string, d date", ("a", None), (None, dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 1)), ("c", dt.date(2024, 1, 1)))
    dim = rows("player_id string, player_sk string, valid_from timestamp, valid_to timestamp",
               ("a", "va", dt.datetime(2023, 1, 1), None), (None, "vn", dt.datetime(2023, 1, 1), None), ("b", "vb", None, None))
    assert as_set(joins.version_at(facts, dim, "player_id", "d"), "player_id", "player_sk") == {
        ("a", None), (None, None), ("b", "vb"), ("c", None)}


def test_all_rules_of_a_table_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "x", 0.5, "a"), (1, "y", 2.0, "b"), (2, "y", None, None), (None, "y", -1.0, "zz"), (None, None, 0.1, "a")],
                          "id bigint, code string, share double, kind string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    rules = [quality.unique("id"), quality.not_null("id"), quality.unique("code"), quality.in_range("share", 0, 1),
             quality.accepted("kind", "a", "b"), quality.unique("kind"), quality.not_null("code")]
    report = quality.run_checks(df, "t", rules)
    assert scans(report) == 1
    assert [(r["check"], r["column_name"], r["violations"]) for r in report.collect()] == [
        ("unique", "id", 1), ("not_null", "id", 2), ("unique", "code", 1), ("range", "share", 2), ("accepted_values", "kind", 1),
        ("unique", "kind", 1), ("not_null", "code", 1)]
    empty = quality.run_checks(df.limit(0), "t", rules).collect()
    assert len(empty) == 7 and {r["violations"] for r in empty} == {0}


def test_records_that_hold_no_event_are_kept_apart(rows):
    values = ['{"k": 1, "s": "a"}', '{"k": 2', None, "[]x", '{"k": "many", "s": "b"}', "{}", '{"k": 3, "other": 1}']
    raw = rows("value binary, offset bigint, partition int", *[(v.encode() if v is not None else None, i, 0) for i, v in enumerate(values)])
    good, bad = decode_or_reject(raw, declare("BIGINT k", "STRING s"))
    assert as_set(good, "kafka_offset", "k", "s") == {(0, 1, "a"), (5, None, None), (6, 3, None)}
    assert as_set(bad, "kafka_offset", "reason") == {(1, "not readable"), (2, "no value"), (3, "not readable"), (4, "not readable")}
    assert {r.value for r in bad.collect()} == {values[1], None, values[3], values[4]}
    assert json.loads(values[0])["k"] == 1


def test_positions_are_those_of_the_sorted_rows(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 5 = 0, null, concat('p', id % 7)) AS kind", "if(id % 9 = 0, null, id % 100) AS age")
    then = (F.col("age").desc_nulls_last(), F.col("id"))
    ranked = review.ranked_by(df, "kind", ("p3", "p1"), *then)
    in_order = [r.id for r in review.order_by_rank(df, "kind", ("p3", "p1"), *then).collect()]
    assert [r.id for r in sorted(ranked.collect(), key=lambda r: r.position)] == in_order
