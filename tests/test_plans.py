"""Properties of the physical plans that decide whether they hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from podium.functions.predicates import non_negative, require
from podium.operators import joins, windows
from podium.plans import marts
from podium.session import scratch_dir
from podium.sources import readers, sinks
from workload.history import order_matches, shipped_days
from workload.tables import Tables

SF_DIR = "/root/testdata/sf0.001"
# Queries that run jobs of their own (writes, streams) while they are put together.
EAGER = {n for n in entry.queries() if n.startswith(("stream_", "extracted_", "extraction_f")) or n in (
    "csv_round_trip", "partitioned_write", "insert_twice", "digest_in_increments", "report_in_increments",
    "upsert_months", "append_new_column", "table_or_empty", "check_marts")}


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF_DIR)


@pytest.fixture
def no_broadcast(spark):
    """The plans of tables too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - EAGER))
def test_no_cross_join(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BroadcastHashJoin" not in text  # nothing forces a broadcast


@pytest.mark.parametrize("name", ["development_score", "monthly_report", "link_to_match", "daily_rollup", "scd2_history"])
def test_no_python_in_the_models(spark, name):
    assert "Python" not in plan(entry.queries()[name](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(t):
    df = require(t.lineitem, ["l_shipdate"]).filter(non_negative(["l_quantity"])).select("l_orderkey")
    text = plan(df)
    assert "GreaterThanOrEqual(l_quantity,0" in text and "IsNotNull(l_shipdate)" in text
    assert re.search(r"ReadSchema: struct<([^>]*)>", text).group(1).count(":") == 3


def test_new_only_reads_the_keys_of_the_target(t):
    text = plan(joins.new_only(t.orders, t.orders.filter("o_orderstatus = 'F'"), ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_ranking_is_limited_before_the_shuffle(t):
    text = plan(windows.latest(t.orders, ["o_custkey"], [F.col("o_orderdate").desc()], 5))
    assert "Partial" in text[text.index("Exchange"):]


def test_score_is_one_shuffle_over_stored_facts(spark, t):
    folder = scratch_dir(spark, "facts")
    matches = sinks.materialize(order_matches(t), f"{folder}/m")
    training = sinks.materialize(shipped_days(t), f"{folder}/t")
    text = plan(marts.development_score(matches, training))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert "avg_forehand_cross_court_in" in text and "first_serve_pct" not in text  # pruned at the scan


def test_full_outer_join_reuses_the_grouping(spark, no_broadcast):
    text = plan(entry.queries()["full_outer_weeks"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 2


def test_nearest_following_forms_no_pairs(spark, t, no_broadcast):
    clicks = shipped_days(t).select("player_id", "session_date")
    text = plan(joins.nearest_following(clicks, order_matches(t).select("player_id", "match_date", "match_id"), "player_id",
                                        "session_date", "match_date", 7, ["match_id"], "gap"))
    assert text.count("Join") == text.count("SortMergeJoin") == 1  # items to their order, nothing else


def test_window_join_is_keyed_by_time(spark, t, no_broadcast):
    text = plan(entry.queries()["forward_window"](spark, SF_DIR))
    assert "SortMergeJoin [user_id" in text and "_slot" in text[text.index("SortMergeJoin"):].split("\n")[0]


def test_partition_filter_prunes_folders(spark, t):
    stored = sinks.materialize(t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")),
                               scratch_dir(spark, "orders"), ["month"], ["o_custkey"])
    assert "PartitionFilters: [isnotnull(month" in plan(stored.filter(F.col("month") >= "1997-03"))


def test_upsert_reads_touched_partitions_only(spark, t):
    target = scratch_dir(spark, "orders")
    orders = t.orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    sinks.overwrite(orders, target, ["month"])
    touched = orders.filter("o_orderstatus = 'P' AND o_orderkey >= 0").select("month").distinct()
    assert "dynamicpruning" in plan(readers.table(spark, target).join(touched, "month", "left_semi"))


@pytest.fixture
def eager_skew_split(spark, no_broadcast):
    """Limits at which AQE treats partitions of this size as skewed."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
                "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}  # the plans must do without it
    before = {n: spark.conf.get(n, None) for n in settings}
    for n, value in settings.items():
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


@pytest.mark.parametrize("lookup", ["alias", "dimension", "pages", "unseen"])
def test_a_busy_key_is_split_in_lookups(spark, eager_skew_split, lookup):
    """A third of the rows use one key; without broadcasts AQE still spreads them over tasks."""
    rows = spark.range(0, 120_000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'star' ELSE concat('p', id % 5000) END AS player_id", "1 AS page_number",
        "CASE WHEN id % 3 = 0 THEN 'star' ELSE concat('p', id % 5000) END AS session_id", "uuid() AS path")
    players = spark.range(5000).selectExpr(
        "concat('p', id) AS player_id", "concat('sk', id) AS player_sk", "concat('p', id) AS alias",
        "concat('x', id) AS canonical_player_id", "true AS is_current", "TIMESTAMP'2024-01-01' AS valid_from")
    if lookup == "alias":
        df = joins.resolve_alias(rows, "player_id", players)
    elif lookup == "dimension":
        df = joins.lookup_sk(rows, players)
    elif lookup == "unseen":
        known = players.select(F.concat("player_id", F.lit("-done")).alias("session_id"))
        todo = joins.new_only(rows, known, ["session_id"], busy_keys=True)
        df = todo.groupBy("session_id", "page_number").agg(F.max("path"))
    else:
        from podium.operators.summaries import group_pages

        df = group_pages(rows, ["session_id"], "page_number", "path", chunk=20)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
