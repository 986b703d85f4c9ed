from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import as_dict, as_set
from podium.operators import changes, joins, summaries, windows
from podium.operators.conform import conform, map_fields, with_lineage
from podium.schemas import EVAL_SET, INTAKE_FIELDS, INTAKE_REQUIRED, declare


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def ts(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_resolve_alias(rows):
    seed = rows("alias string, canonical_player_id string", (" YI ", "p1"), ("yi", "p0"), ("garret", "p2"))
    df = rows("id int, player_id string", (1, "Yi"), (2, " GARRET "), (3, "Unmapped "), (4, None))
    assert as_dict(joins.resolve_alias(df, "player_id", seed), "id", "player_id") == {1: "p0", 2: "p2", 3: "unmapped", 4: None}


def test_lookup_never_fans_out(rows):
    dim = rows("player_id string, player_sk string, valid_from timestamp, is_current boolean",
               ("a", "old", ts(0), True), ("a", "new", ts(5), True), ("b", "x", ts(0), False), (None, "n", ts(0), True))
    facts = rows("id int, player_id string", (1, "a"), (2, "b"), (3, "c"), (4, None))
    assert as_dict(joins.lookup_sk(facts, dim), "id", "player_sk") == {1: "new", 2: None, 3: None, 4: None}


LEFT = [("a", 0), ("a", 10), ("a", 20), ("b", 0), ("c", 3)]
RIGHT = [("a", 0, "0900", "m1"), ("a", 7, "0900", "m2"), ("a", 18, "1000", "m3"), ("a", 28, "0900", "m4"),
         ("b", 7, "1500", "m6"), ("b", 7, "0800", "m5"), ("c", 2, "0800", "m7"), ("c", 11, "0800", "m8")]


def linked(rows, days=7):
    left = rows("player string, trained date", *[(p, day(d)) for p, d in LEFT])
    right = rows("player string, played date, time string, match string", *[(p, day(d), t, m) for p, d, t, m in RIGHT])
    return left, right, joins.nearest_following(left, right, "player", "trained", "played", days, ["time", "match"], "gap")


def test_nearest_following_edges(rows):
    """Day 0, day 7 and day 8, two matches on a day, none, a match before the session."""
    found = {(r["player"], r["trained"]): (r["match"], r["gap"]) for r in linked(rows)[2].collect()}
    assert found == {("a", day(0)): ("m1", 0), ("a", day(10)): (None, None), ("a", day(20)): (None, None),
                     ("b", day(0)): ("m5", 7), ("c", day(3)): (None, None)}


def test_nearest_following_keeps_one_row_per_left_row(rows):
    left, _, result = linked(rows, 8)
    assert result.count() == left.count()
    assert as_dict(result.filter("player = 'a'"), "trained", "gap") == {day(0): 0, day(10): 8, day(20): 8}


@pytest.mark.parametrize("days", [0, 1, 7, 30])
def test_window_join_against_brute_force(rows, days):
    left, right, _ = linked(rows)
    got = as_set(joins.forward_window_join(left, right, "player", "trained", "played", days), "player", "trained", "match")
    expected = set()
    for p, d in LEFT:
        hits = {(p, day(d), m) for q, e, _, m in RIGHT if q == p and d <= e <= d + days}
        expected |= hits or {(p, day(d), None)}
    assert got == expected


def test_nearest_is_the_closest_of_the_window_join(rows):
    left, right, nearest = linked(rows, 30)
    pairs = joins.forward_window_join(left, right, "player", "trained", "played", 30)
    best = windows.top1(pairs, ["player", "trained"], [F.col("played").asc_nulls_last(), "time", "match"])
    assert as_set(best, "player", "trained", "match") == as_set(nearest, "player", "trained", "match")


def test_not_reviewed_survives_nulls(rows):
    queue = rows("session_id string", ("a",), ("b",))
    reviewed = rows("session_id string", ("a",), (None,))
    assert as_set(joins.not_reviewed(queue, reviewed)) == {("b",)}


def test_version_at(rows):
    dim = rows("player_id string, player_sk string, valid_from timestamp, valid_to timestamp",
               ("a", "v1", ts(0), ts(10) + dt.timedelta(hours=9)), ("a", "v2", ts(10) + dt.timedelta(hours=9), ts(20)),
               ("a", "v3", ts(30), None))
    facts = rows("id int, player_id string, d date", *[(i, "a", day(i)) for i in (0, 10, 11, 20, 25, 30, 99)], (-1, "b", day(0)))
    assert as_dict(joins.version_at(facts, dim, "player_id", "d"), "id", "player_sk") == {
        0: "v1", 10: "v1", 11: "v2", 20: None, 25: None, 30: "v3", 99: "v3", -1: None}


def test_unseen_deduplicates_inside_and_across_batches(rows):
    existing = rows("id int, v string", (1, "old"))
    batch = rows("id int, v string", (1, "new"), (2, "b"), (2, "a"), (3, "c"))
    assert as_set(changes.unseen(batch, existing, ["id"], ["v"])) == {(2, "a"), (3, "c")}
    assert as_set(changes.unseen(batch, None, ["id"], ["v"])) == {(1, "new"), (2, "a"), (3, "c")}
    assert changes.unseen(batch.limit(0), existing, ["id"], ["v"]).count() == 0


def test_upsert_and_replace(rows):
    target = rows("id int, v string", (1, "a"), (2, "b"))
    assert as_set(changes.upsert(target, rows("id int, v string", (2, "B"), (3, "c")), ["id"])) == {(1, "a"), (2, "B"), (3, "c")}
    fresh = rows("id int, extra int", (9, 1))
    assert as_set(changes.replace_slice(target, fresh, F.col("id") == 1)) == {(1, "a", None), (9, None, 1)}


@pytest.mark.parametrize("target,passed", [(None, {1, 5, 9}), ([], {1, 5, 9}), ([5], {9}), ([9], set()), ([4], {5, 9})])
def test_newer_than(rows, target, passed):
    df = rows("k int", (1,), (5,), (9,))
    known = None if target is None else rows("k int", *[(k,) for k in target])
    assert {r["k"] for r in changes.newer_than(df, "k", known, "k").collect()} == passed


def test_newer_than_look_back(rows):
    df, known = rows("k int", (1,), (5,), (9,)), rows("k int", (9,))
    assert {r["k"] for r in changes.newer_than(df, "k", known, "k", F.col("_high") - 5).collect()} == {5, 9}


def test_status_and_approval(rows):
    findings = rows("finding_id string, coach_status string", ("a", "pending"), ("b", "pending"), ("c", "confirmed"))
    decided = rows("finding_id string, coach_status string, decided_at timestamp",
                   ("a", "confirmed", ts(1)), ("a", "dismissed", ts(2)), ("z", "confirmed", ts(1)))
    assert as_set(changes.set_status(findings, decided)) == {("a", "dismissed"), ("b", "pending"), ("c", "confirmed")}
    empty = rows(EVAL_SET)
    batch = rows("session_id string, raw_note_text string, issue string", ("s1", "it's 'fine'", ""))
    r = changes.approve(empty, batch, F.lit(ts(3)).cast("timestamp")).first()
    assert (r["raw_note_text"], r["issue"], r["sentiment"], r["approved_at"]) == ("it's 'fine'", None, None, ts(3))


def history(rows):
    snapshots = rows("player_id string, valid_from date, level string, seq int",
                     ("a", day(0), "x", 1), ("a", day(1), "x", 2), ("a", day(2), "y", 3), ("a", day(2), "z", 4),
                     ("a", day(5), "x", 5), ("b", day(3), None, 6))
    return changes.scd2_history(snapshots, "player_id", ["level"], "valid_from", [F.col("seq").desc()])


def test_scd2_history(rows):
    assert as_set(history(rows), "player_id", "valid_from", "level", "valid_to", "is_current") == {
        ("a", day(0), "x", day(2), False), ("a", day(2), "z", day(5), False), ("a", day(5), "x", None, True),
        ("b", day(3), None, None, True)}


def test_scd2_apply_is_idempotent(rows):
    dim = history(rows).withColumns({
        "valid_from": F.col("valid_from").cast("timestamp"), "valid_to": F.col("valid_to").cast("timestamp")}).drop("seq")
    incoming = rows("player_id string, level string", ("a", "x"), ("b", "w"), ("c", "n"), ("c", "m"))
    as_of = F.lit(ts(50)).cast("timestamp")
    once = changes.scd2_apply(dim, incoming, "player_id", ["level"], as_of, ["level"])
    assert as_set(once.filter("is_current"), "player_id", "level", "valid_from") == {
        ("a", "x", ts(5)), ("b", "w", ts(50)), ("c", "m", ts(50))}
    assert as_set(once.filter("player_id = 'b' and not is_current"), "level", "valid_to") == {(None, ts(50))}
    twice = changes.scd2_apply(once, incoming, "player_id", ["level"], F.lit(ts(60)).cast("timestamp"), ["level"])
    assert as_set(twice) == as_set(once)


def test_latest_and_change(rows):
    df = rows("p string, d date, v double", ("a", day(0), 1.0), ("a", day(1), 3.5), ("a", day(9), 3.0), ("b", day(0), 2.0))
    assert windows.latest(df, ["p"], [F.col("d").desc()], 2).count() == 3
    changed = windows.with_change(df, ["p"], ["d"], "v", "before", "change")
    assert {(r["p"], r["d"]): r["change"] for r in changed.collect()} == {
        ("a", day(0)): None, ("a", day(1)): 2.5, ("a", day(9)): -0.5, ("b", day(0)): None}


def test_rolling_days_includes_exactly_the_window(rows):
    df = rows("p string, d date, n bigint", ("a", day(0), 1), ("a", day(29), 1), ("a", day(30), 1))
    assert as_dict(windows.rolling_days(df, ["p"], "d", 30, {"s": "n"}), "d", "s") == {day(0): 1, day(29): 2, day(30): 2}


def test_mode_breaks_ties_by_value(rows):
    df = rows("p string, v string", ("a", "y"), ("a", "x"), ("b", None), ("c", "z"), ("c", "z"), ("c", "a"))
    assert as_dict(windows.mode_per_group(df, ["p"], "v", "top"), "p", "top") == {"a": "x", "c": "z"}


def test_group_pages_shares_out_long_sessions(rows):
    pages = [("s", i, f"p{i:03d}") for i in range(1, 8)] + [("t", 1, f"copy{i:03d}") for i in range(40)]
    df = rows("session_id string, page_number int, path string", *pages)
    grouped = summaries.group_pages(df, ["session_id"], "page_number", "path", chunk=5).collect()
    assert sorted(p for r in grouped for p in r["file_paths"]) == sorted(p for _, _, p in pages)
    assert {(r["session_id"], r["part"], r["share"]) for r in grouped if r["session_id"] == "s"} == {("s", 0, 0), ("s", 1, 0)}
    assert all(r["file_paths"] == sorted(r["file_paths"]) for r in grouped)
    assert max(r["page_count"] for r in grouped) < 20


def test_recent_win_rate_looks_at_the_last_n(rows):
    df = rows("p string, d date, won boolean", ("a", day(0), False), ("a", day(1), True), ("a", day(2), None))
    assert tuple(summaries.recent_win_rate(df, "p", [F.col("d").desc()], "won", 2).first()) == ("a", 1, 2, 0.5)


def test_accuracy_of_nothing_is_zero(rows):
    df = rows("a string, b string", ("x", "x"), ("x", None))
    assert summaries.match_accuracy(df, "a", "b").first()["accuracy"] == 0.5
    assert tuple(summaries.match_accuracy(df.limit(0), "a", "b").first()) == (0, 0, 0.0)


def test_conform(rows):
    schema = declare("BIGINT n", "DATE d", "STRING missing", "DOUBLE x")
    got = conform(rows("x string, n string, d string, extra int", ("1.5", "oops", "20259999", 1)), schema)
    assert got.schema.names == schema.names and [f.dataType for f in got.schema] == [f.dataType for f in schema]
    assert tuple(got.first()) == (None, None, None, 1.5)


def test_lineage_keeps_a_stated_ingest_time(rows):
    df = with_lineage(rows("id string, _ingested_at timestamp", ("a", ts(0)), ("b", None)), "f", "v1", ["id"],
                      F.lit(ts(9)).cast("timestamp"))
    assert as_dict(df, "id", "_ingested_at") == {"a": ts(0), "b": ts(9)}
    assert df.select("_record_hash").distinct().count() == 2


def test_map_fields_requires_answers(spark):
    full = {field: "1" for field in INTAKE_FIELDS}
    partial = {field: "1" for field, name in INTAKE_FIELDS.items() if name != "contact_email"}
    df = spark.createDataFrame([("a", full), ("b", partial)], "id string, answers map<string,string>")
    assert as_set(map_fields(df, "answers", INTAKE_FIELDS, INTAKE_REQUIRED), "id") == {("a",)}
