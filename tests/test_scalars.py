from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_dict
from podium.functions import predicates, scalars
from podium.functions.aggregates import mean_rounded, ratio_of, spread
from podium.functions.text import encode_content, parse_session_files, strip_fences, strip_scheme, valid_session_file


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("num,den,expected", [
    (1, 3, 0.3333), (2, 3, 0.6667), (5, 0, None), (5, None, None), (None, 4, None), (0, 4, 0.0), (1, -2, None)])
def test_safe_ratio(rows, num, den, expected):
    df = rows("n bigint, d bigint", (num, den))
    assert df.select(scalars.safe_ratio("n", "d").alias("r")).first()["r"] == expected


@pytest.mark.parametrize("won,value", [(True, 1.0), (False, 0.0), (None, 0.0)])
def test_win_value(spark, won, value):
    assert one(spark, scalars.win_value(F.lit(won).cast("boolean"))) == value


@pytest.mark.parametrize("rating,weight", [
    (None, 1.0), (7.0, 1.0), (9.0, 1.2), (16.5, 1.95), (20.0, 2.0), (2.0, 0.5), (0.0, 0.5)])
def test_opponent_strength(spark, rating, weight):
    assert one(spark, scalars.opponent_strength(F.lit(rating).cast("double"))) == pytest.approx(weight)


@pytest.mark.parametrize("change,trend", [
    (2.0, "stable"), (-2.0, "stable"), (2.01, "improving"), (-2.01, "declining"), (None, "stable"), (0.0, "stable")])
def test_trend(spark, change, trend):
    assert one(spark, scalars.classify_trend(F.lit(change).cast("double"))) == trend


@pytest.mark.parametrize("value,scaled", [("0.5", 0), ("2.0", 100), ("1.25", 50), ("0.1", 0), ("3.0", 100)])
def test_rescale_clamps_at_both_ends(spark, value, scaled):
    column = scalars.rescale(F.lit(Decimal(value)), Decimal("0.5"), Decimal("2.0"))
    assert float(one(spark, column)) == scaled


def test_capped_has_no_lower_limit(spark):
    assert float(one(spark, scalars.capped(F.lit(-0.5), 100))) == -50
    assert float(one(spark, scalars.capped(F.lit(2.0), 100))) == 100


def test_surrogate_key_keeps_the_place_of_nulls(rows):
    df = rows("a string, b string", ("x", None), (None, "x"), ("x", "x"), (None, None))
    assert df.select(scalars.surrogate_key("a", "b").alias("k")).distinct().count() == 4


def test_deterministic_id_repeats(rows):
    df = rows("a string", ("x",))
    first, second = (df.select(scalars.deterministic_id("a").alias("k")).first()["k"] for _ in range(2))
    assert first == second


def test_calendar(rows):
    df = scalars.with_calendar(rows("d date", (dt.date(2024, 3, 3),)), "d", "m")  # a Sunday
    assert tuple(df.first()) == (dt.date(2024, 3, 3), dt.date(2024, 2, 26), dt.date(2024, 3, 1), "2024-03")


def test_labels(spark):
    assert one(spark, scalars.percent_label(F.lit(0.4535))) == "45.4%"
    assert one(spark, scalars.percent_label(scalars.typed_null("double"))) == "N/A"
    assert one(spark, scalars.map_values(F.lit(True), {True: "Win", False: "Loss"}, "-")) == "Win"
    assert one(spark, scalars.map_values(scalars.typed_null("boolean"), {True: "Win"}, "-")) == "-"
    assert [one(spark, scalars.confidence_band(F.lit(v))) for v in (0.59, 0.6, 0.79, 0.8)] == ["low", "medium", "medium", "high"]
    assert [one(spark, scalars.rank_of(F.lit(v), ("high", "medium"))) for v in ("high", "medium", "low")] == [1, 2, 3]


def test_fill_defaults_keeps_types(rows):
    df = scalars.fill_defaults(rows("a double, b bigint", (None, None)), {"a": 1, "b": 0})
    assert tuple(df.first()) == (1.0, 0)
    assert dict(df.dtypes) == {"a": "double", "b": "bigint"}


def test_null_semantics_of_filters(rows):
    df = rows("a bigint, u double, c string", (None, None, None), (-1, 17.0, "social"), (0, 16.5, "competitive"))
    assert df.filter(predicates.non_negative(["a"])).count() == 1
    assert df.filter(predicates.in_range_or_null("u", 0, 16.5)).count() == 2
    assert df.filter(predicates.in_set_or_null("c", ["competitive"])).count() == 2
    assert df.filter(predicates.not_provenance("c", "social")).count() == 2
    assert predicates.require(df, ["a", "c"]).count() == 2
    assert predicates.maybe_eq(df, "c", "social").count() == 1
    assert predicates.maybe_eq(df, "c").count() == 3


def test_mean_rounded_is_exact_at_the_half(rows):
    """0.12345 rounds up whatever the order in which its parts are added."""
    df = rows("x double", *[(v,) for v in (0.1234, 0.1235, None)])
    assert df.agg(mean_rounded("x", 4).alias("m")).first()["m"] == 0.1235
    assert df.filter("false").agg(mean_rounded("x", 4).alias("m")).first()["m"] is None
    shuffled = rows("x double", *[(v,) for v in [0.1] * 7 + [0.3] * 5 + [0.2449]])
    exact = (0.7 + 1.5 + 0.2449) / 13
    for partitions in (1, 3, 7):
        got = shuffled.repartition(partitions).agg(mean_rounded("x", 4).alias("m")).first()["m"]
        assert got == round(exact, 4)


def test_ratio_and_spread(rows):
    df = rows("x double", (1.0,), (4.5,))
    assert df.agg(spread("x").alias("s")).first()["s"] == 3.5
    empty = df.filter("false").agg(ratio_of(F.count("x"), F.count("x")).alias("r"))
    assert empty.first()["r"] is None


FILES = {
    "/raw/202503151400_alex_match_1.png": ("2025-03-15", "1400", "alex", "match", 1, True),
    "dbfs:/raw/202503151400_alex_training_12.png": ("2025-03-15", "1400", "alex", "training", 12, True),
    "/raw/202599991400_alex_match_1.png": (None, "1400", "alex", "match", 1, False),
    "/raw/202503151400_alex_match.png": ("2025-03-15", "1400", "alex", "match", None, False),
    "/raw/202503151400_alex_warmup_1.png": ("2025-03-15", "1400", "alex", "", None, False),
    "/raw/202503151400_alex_j_match_1.png": ("2025-03-15", "1400", "alex", "", 1, False),
    "/raw/202503151400_alex_match_1.PNG": (None, "", "", "", None, False),
    "/raw/notes.png": (None, "", "", "", None, False),
}


def test_parse_session_files(rows):
    parsed = parse_session_files(rows("path string", *[(p,) for p in FILES]))
    valid = {r["path"] for r in valid_session_file(parsed).collect()}
    for r in parsed.collect():
        day = r["session_date"] and r["session_date"].isoformat()
        assert (day, r["session_time"], r["player_name"], r["session_type"], r["page_number"], r["path"] in valid) \
            == FILES[r["path"]], r["path"]
    ids = as_dict(parsed, "path", "session_id")
    assert ids["/raw/202503151400_alex_match_1.png"] == "202503151400_alex_match"


@pytest.mark.parametrize("text,answer", [
    ('{"a": 1}', '{"a": 1}'), ('```json\n{"a": 1}\n```', '{"a": 1}'), (' ```\n{"a":\n 1}\n  ```\n', '{"a":\n 1}'),
    ('say ```x```', 'say ```x```'), ("", "")])
def test_strip_fences_matches_its_row_level_twin(spark, text, answer):
    from podium.plans.extraction import unfenced

    assert one(spark, strip_fences(F.lit(text))) == answer == unfenced(text)


def test_content_and_scheme(spark):
    assert one(spark, encode_content(F.lit(bytearray(b"x" * 100)))).count("\n") == 0
    assert one(spark, strip_scheme(F.lit("dbfs:/a/b"))) == "/a/b"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_mean_rounded_reads_whole_values(spark, rows, ansi):
    cases = {"nan": ([float("nan"), 2.0], None), "inf": ([float("inf"), 1.0], float("inf")), "large": ([1e15, 1e15], 1e15),
             "huge": ([1e30, 1e30], 1e30), "mixed": ([1e13, 1e12], 5.5e12), "half": ([-0.00005, -0.00005], -0.0001),
             "digits": ([0.12344999, 0.12344999], 0.1234), "empty": ([None], None)}
    df = rows("name string, x double", *[(n, x) for n, (values, _) in cases.items() for x in values])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = {r["name"]: r["m"] for r in df.groupBy("name").agg(mean_rounded("x", 4).alias("m")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got.pop("nan") != cases.pop("nan")[1] and got == {n: m for n, (_, m) in cases.items()}
