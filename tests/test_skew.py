"""One player holds a third of all rows: results stay whole, and busy groups shrink early."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from podium.operators import changes, joins, summaries, windows
from podium.plans import intermediate, marts, staging
from podium.schemas import ALIAS_SEED, RAW_MATCHES, RAW_TRAINING
from podium.operators.conform import conform

N = 60_000


@pytest.fixture(scope="module")
def facts(spark):
    player = "CASE WHEN id % 3 = 0 THEN 'star' ELSE concat('p', id % 997) END AS player_id"
    base = spark.range(N)
    matches = conform(base.selectExpr(
        "concat('m', id) AS match_id", player, "date_add(DATE'2023-01-01', CAST(id % 700 AS INT)) AS match_date",
        "lpad(id % 24, 4, '0') AS session_time", "id % 2 = 0 AS player_won", "id % 30 AS winners", "id % 20 AS unforced_errors",
        "id % 5 AS break_points_won", "id % 7 AS break_points_total", "0.9D AS extraction_confidence"), RAW_MATCHES)
    training = conform(base.selectExpr(
        "concat('t', id) AS session_id", player, "date_add(DATE'2023-01-01', CAST(id % 690 AS INT)) AS session_date",
        "(id % 100) / 100 AS shots_in", "(id % 90) / 100 AS forehand_cross_court_in", "id % 300 AS shots_per_hour",
        "0.9D AS extraction_confidence"), RAW_TRAINING)
    alias = staging.stg_alias(spark.createDataFrame([("Star", "star", "x")], ALIAS_SEED))
    strength = intermediate.match_strength(staging.stg_match(matches, alias))
    return strength, intermediate.daily_rollup(staging.stg_training(training, alias))


def test_rollup_counts_every_session(facts):
    assert facts[1].agg(F.sum("sessions_on_day")).first()[0] == N
    star = facts[1].filter("player_id = 'star'")
    assert star.agg(F.sum("sessions_on_day")).first()[0] == N // 3 and star.count() <= 690


def test_linkage_of_the_busy_player_against_brute_force(facts):
    strength, rollup = facts
    linked = {r["training_date"]: (r["match_id"], r["days_to_match"])
              for r in intermediate.link_to_match(rollup.filter("player_id = 'star'"), strength).collect()}
    played = {}
    for r in strength.filter("player_id = 'star'").select("match_date", "session_time", "match_id").collect():
        best = (r["session_time"], r["match_id"])
        played[r["match_date"]] = min(played.get(r["match_date"], best), best)
    for day, found in linked.items():
        ahead = [d for d in range(8) if day + dt.timedelta(days=d) in played]
        assert found == ((played[day + dt.timedelta(days=ahead[0])][1], ahead[0]) if ahead else (None, None))


def test_score_keeps_all_matches_and_sessions(facts):
    strength, rollup = (df.withColumn("player_sk", F.lit("sk")) for df in facts)
    total = marts.development_score(strength, rollup).agg(
        F.sum("matches_played").alias("m"), F.sum("sessions_completed").alias("s")).first()
    assert (total["m"], total["s"]) == (N, rollup.count())


def test_rolling_window_of_the_busy_player(facts):
    rolled = marts.rolling_win_rate(facts[0])
    star = rolled.filter("player_id = 'star'").orderBy("match_date").collect()
    wins = {r["match_date"]: r["day_matches"] for r in star}
    for r in star[::97]:
        assert r["matches_in_window"] == sum(wins.get(r["match_date"] - dt.timedelta(days=d), 0) for d in range(30))


def test_top_n_and_dedup_of_a_hot_key(spark):
    df = spark.range(N).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id")
    assert [r["id"] for r in windows.latest(df, ["k"], [F.col("id").desc()], 3).filter("k = 0").orderBy("id").collect()] \
        == [N - 9, N - 6, N - 3]
    assert changes.unseen(df, None, ["k"], ["id"]).count() == N - N // 3 + 1


def test_hot_session_is_shared_out(spark):
    """A third of all pages claim to be page 1 of one session."""
    pages = spark.range(N).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id) END AS session_id", "1 AS page_number", "concat('p', id) AS path")
    grouped = summaries.group_pages(pages, ["session_id"], "page_number", "path", chunk=50)
    sizes = grouped.agg(F.sum("page_count").alias("total"), F.max("page_count").alias("largest")).first()
    assert sizes["total"] == N and sizes["largest"] <= 100


def test_version_lookup_of_a_hot_player(spark):
    facts = spark.range(N).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'star' ELSE concat('p', id) END AS player_id",
                                      "date_add(DATE'2024-01-01', CAST(id % 300 AS INT)) AS d")
    dim = spark.range(100).selectExpr("'star' AS player_id", "concat('v', id) AS player_sk",
                                      "CAST(date_add(DATE'2024-01-01', CAST(3 * id AS INT)) AS TIMESTAMP) AS valid_from",
                                      "CAST(date_add(DATE'2024-01-01', CAST(3 * id + 3 AS INT)) AS TIMESTAMP) AS valid_to")
    got = joins.version_at(facts, dim, "player_id", "d")
    assert got.count() == N
    wrong = got.filter("player_id = 'star'").filter(
        F.coalesce(F.col("player_sk"), F.lit("")) != F.expr("concat('v', CAST(floor(id % 300 / 3) AS INT))"))
    assert wrong.count() == 0
