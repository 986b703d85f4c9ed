from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import as_dict, as_set
from podium.plans import intermediate, marts, staging
from podium.schemas import ALIAS_SEED, RAW_MATCHES, RAW_STUDENTS, RAW_TRAINING
from podium.sources.readers import rows_to_df


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)  # a Monday


@pytest.fixture
def alias(spark):
    return staging.stg_alias(rows_to_df(spark, [{"alias": " YI ", "canonical_player_id": " Yi-1 "}], ALIAS_SEED))


def match(id, player="yi", d=0, **more):
    return {"match_id": id, "player_id": player, "match_date": day(d), "winners": 1, "unforced_errors": 1, **more}


def session(id, player="yi", d=0, **more):
    return {"session_id": id, "player_id": player, "session_date": day(d), "shots_in": 0.5, **more}


def test_stg_match_validates_and_resolves(spark, alias):
    raw = rows_to_df(spark, [
        match("ok", break_points_won=1, break_points_total=3, first_serves_in=4, first_serves_total=0),
        match("no-winners", winners=None), match("negative", winners=-1), match("no-player", player=None),
        {**match("no-date"), "match_date": None}, match("other", player=" Kim")], RAW_MATCHES)
    staged = staging.stg_match(raw, alias)
    assert as_dict(staged, "match_id", "player_id") == {"ok": "yi-1", "other": "kim"}
    ok = staged.filter("match_id = 'ok'").first()
    assert (ok["break_point_conversion"], ok["first_serve_pct"], ok["aces"]) == (0.3333, None, None)


def test_stg_match_reads_a_file_without_the_optional_columns(spark, alias):
    raw = rows_to_df(spark, [match("a")], RAW_MATCHES).drop("opponent_name", "surface")
    assert staging.stg_match(raw, alias).first()["opponent_name"] is None


def test_stg_training_range(spark, alias):
    raw = rows_to_df(spark, [session(str(v), shots_in=v) for v in (None, 0.0, 1.0, 1.0001, -0.1)], RAW_TRAINING)
    assert as_set(staging.stg_training(raw, alias), "session_id") == {("0.0",), ("1.0",)}


def test_stg_student_keeps_the_current_version(spark):
    raw = rows_to_df(spark, [
        {"student_id": "a", "preferred_name": " Yi ", "dominant_hand": "Right", "is_current": True},
        {"student_id": "b", "is_current": False}, {"student_id": "c"}], RAW_STUDENTS)
    assert as_set(staging.stg_student(raw), "student_id", "preferred_name", "dominant_hand") == {("a", "yi", "right")}


def test_daily_rollup_two_sessions_a_day(spark, alias):
    raw = rows_to_df(spark, [
        session("a", shots_in=0.1234, shots_per_hour=100, serves_in_ad=0.5, longest_rally=3),
        session("b", shots_in=0.1235, shots_per_hour=51, longest_rally=9)], RAW_TRAINING)
    r = intermediate.daily_rollup(staging.stg_training(raw, alias)).first()
    assert (r["sessions_on_day"], r["total_shots_per_hour"], r["max_longest_rally"]) == (2, 151, 9)
    assert (r["avg_shots_in"], r["avg_serves_in_ad"], r["avg_serves_in_deuce"]) == (0.1235, 0.5, None)


def models(spark, alias, matches, sessions, students=()):
    strength = intermediate.match_strength(staging.stg_match(rows_to_df(spark, matches, RAW_MATCHES), alias))
    rollup = intermediate.daily_rollup(staging.stg_training(rows_to_df(spark, sessions, RAW_TRAINING), alias))
    dim = marts.dim_player(staging.stg_student(rows_to_df(spark, list(students), RAW_STUDENTS)))
    return marts.fct_match(strength, dim), marts.fct_training(rollup, dim)


def test_score_of_each_kind_of_week(spark, alias):
    won = {"break_points_won": 1, "break_points_total": 2}
    facts = models(spark, alias, [
        match("m1", "only-matches", player_won=True, **won), match("m2", "both", player_won=False),
        match("m3", "both", d=1, player_won=None)],
        [session("s1", "only-training", forehand_cross_court_in=0.8, backhand_cross_court_in=0.6),
         session("s2", "both", forehand_cross_court_in=0.8)])
    got = {r["player_id"]: r for r in marts.development_score(*facts).collect()}
    assert set(got) == {"only-matches", "only-training", "both"}
    assert got["only-matches"]["development_score"] == pytest.approx(0.4 * 50 + 10 + 0.1 * 50, abs=0.01)
    assert got["only-training"]["development_score"] == pytest.approx(10 + 0.2 * 70, abs=0.01)
    assert got["only-training"]["matches_played"] == 0
    assert got["both"]["matches_won"] == 0 and got["both"]["matches_played"] == 2
    assert got["both"]["technique_score"] == 40.0 and got["both"]["opponent_strength_score"] == 33.33
    assert all(r["score_week"] == day(0) for r in got.values())


def test_stacked_grouping_equals_the_full_outer_join(spark, alias):
    matches = [match(f"m{i}", f"p{i % 5}", d=3 * i, player_won=i % 2 == 0) for i in range(40)]
    sessions = [session(f"s{i}", f"p{i % 7}", d=2 * i, shots_per_hour=i) for i in range(40)]
    fm, ft = models(spark, alias, matches, sessions)
    week = F.to_date(F.date_trunc("week", "d"))
    left = fm.withColumn("d", F.col("match_date")).groupBy("player_id", week.alias("score_week")).count()
    right = ft.withColumn("d", F.col("session_date")).groupBy("player_id", week.alias("score_week")).count()
    joined = left.join(right, ["player_id", "score_week"], "full").select("player_id", "score_week")
    assert as_set(marts.development_score(fm, ft), "player_id", "score_week") == as_set(joined)


def test_surrogate_key_comes_from_the_dimension(spark, alias):
    students = [{"student_id": "yi-1", "preferred_name": "yi", "is_current": True, "valid_from": dt.datetime(2024, 1, 1)}]
    fm, ft = models(spark, alias, [match("m1"), match("m2", "stranger")], [session("s1")], students)
    sks = as_dict(fm, "match_id", "player_sk")
    assert sks["m1"] is not None and sks["m2"] is None
    assert ft.first()["player_sk"] == sks["m1"]


def scores(spark, *weekly):
    return spark.createDataFrame(
        [("a", "sk", day(7 * w), s, 1, 1, 1, 10.0) for w, s in weekly],
        "player_id string, player_sk string, score_week date, development_score double, matches_played bigint, "
        "matches_won bigint, sessions_completed bigint, avg_shots_per_hour double")


def test_digest_trend_skips_missing_weeks(spark):
    digest = marts.weekly_digest(scores(spark, (0, 10.0), (1, 12.0), (3, 14.5), (4, 12.0)))
    assert as_dict(digest, "week_start", "score_trend") == {
        day(0): "stable", day(7): "stable", day(21): "improving", day(28): "declining"}


@pytest.mark.parametrize("look_back", [0, 1, 2])
def test_digest_increment_equals_full_build(spark, look_back):
    history = scores(spark, (0, 10.0), (1, 12.0), (2, 15.0), (3, 15.5))
    full = marts.weekly_digest(history)
    known = full.filter(F.col("week_start") <= day(7))
    added = marts.weekly_digest(history, known, look_back)
    assert as_set(added) == as_set(full.filter(F.col("week_start") > day(7 - 7 * look_back)))


def test_digest_into_an_empty_target_loads_everything(spark):
    full = marts.weekly_digest(scores(spark, (0, 10.0), (1, 12.0)))
    assert marts.weekly_digest(scores(spark, (0, 10.0), (1, 12.0)), full.limit(0)).count() == 2


def test_report_months(spark, alias):
    fm, ft = models(spark, alias, [match("m1", d=0, player_won=True), match("m2", d=40)],
                    [session("s1", d=0, shots_per_hour=100), session("s2", d=70)])
    report = marts.monthly_report(fm, ft, marts.development_score(fm, ft))
    got = {r["report_month"]: r for r in report.collect()}
    assert set(got) == {"2024-01", "2024-02"}  # March has training only
    assert (got["2024-01"]["sessions_completed"], got["2024-01"]["avg_shots_per_hour"], got["2024-01"]["win_rate"]) == (1, 100.0, 1.0)
    assert (got["2024-02"]["sessions_completed"], got["2024-02"]["avg_shots_per_hour"]) == (0, None)
    assert as_set(marts.monthly_report(fm, ft, marts.development_score(fm, ft), report.filter("report_month = '2024-01'")),
                  "report_month") == {("2024-02",)}


def test_linkage_shows_the_note_of_the_match(spark, alias):
    fm = intermediate.match_strength(staging.stg_match(rows_to_df(spark, [
        match("late", d=3, session_time="1500"), match("early", d=3, session_time="0900", raw_note_text="note")], RAW_MATCHES), alias))
    rollup = intermediate.daily_rollup(staging.stg_training(rows_to_df(spark, [session("s", d=0), session("t", d=9)], RAW_TRAINING), alias))
    got = {r["training_date"]: r for r in intermediate.link_to_match(rollup, fm).collect()}
    assert (got[day(0)]["match_id"], got[day(0)]["days_to_match"], got[day(0)]["raw_note_text"]) == ("early", 3, "note")
    assert got[day(9)]["has_linked_match"] is False and got[day(9)]["match_id"] is None
