"""The marts over a long history: an order is a match, the items shipped on a day are training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.aggregates import mean_rounded
from podium.functions.scalars import safe_ratio
from podium.plans import build, marts
from podium.session import scratch_dir
from podium.sources import sinks
from workload.registry import query
from workload.sql import CTE, cte, mean, n, ratio, week, with_ctes
from workload.tables import Tables

_BREAK = "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice END"


def order_matches(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("match_id"), F.col("o_custkey").alias("player_id"),
        F.lit(None).cast("string").alias("player_sk"), F.to_date("o_orderdate").alias("match_date"),
        (F.col("o_orderstatus") == "F").alias("player_won"),
        F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("weighted_win"),
        F.lit(1.0).alias("opponent_strength_weight"),
        safe_ratio("o_totalprice", "500000").alias("first_serve_pct"),
        safe_ratio(_BREAK, "600000").alias("break_point_conversion"))


def shipped_days(t: Tables) -> DataFrame:
    items = t.lineitem.join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.groupBy(F.col("o_custkey").alias("player_id"), F.to_date("l_shipdate").alias("session_date")).agg(
        F.count(F.lit(1)).alias("sessions_on_day"), F.sum("l_quantity").cast("bigint").alias("total_shots_per_hour"),
        mean_rounded("l_discount * 10", 4).alias("avg_forehand_cross_court_in"),
        mean_rounded("l_tax * 10", 4).alias("avg_backhand_cross_court_in"),
    ).withColumn("player_sk", F.lit(None).cast("string"))


# The same models in SQL, over these facts instead of the events.
cte("long_match", (), f"""
    SELECT o_orderkey AS match_id, o_custkey AS player_id, NULL AS player_sk, CAST(o_orderdate AS DATE) AS match_date,
           {week('o_orderdate')} AS match_week, o_orderstatus = 'F' AS player_won,
           CASE WHEN o_orderstatus = 'F' THEN 1.0e0 ELSE 0.0e0 END AS weighted_win, 1.0e0 AS opponent_strength_weight,
           {ratio('o_totalprice', '500000')} AS first_serve_pct, {ratio(f'({_BREAK})', '600000')} AS break_point_conversion
    FROM orders""")
cte("long_training", (), f"""
    SELECT o_custkey AS player_id, NULL AS player_sk, CAST(l_shipdate AS DATE) AS session_date,
           {week('CAST(l_shipdate AS DATE)')} AS session_week,
           count(*) AS sessions_on_day, {n('sum(l_quantity)')} AS total_shots_per_hour,
           {mean('l_discount * 10', 4)} AS avg_forehand_cross_court_in, {mean('l_tax * 10', 4)} AS avg_backhand_cross_court_in
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
for _name, _needs in (("match_weeks", ("long_match",)), ("training_weeks", ("long_training",)),
                      ("weeks", ("long_match_weeks", "long_training_weeks")), ("parts", ("long_weeks",)),
                      ("score", ("long_parts",)), ("digest", ("long_score",)),
                      ("report", ("long_match", "long_training", "long_score"))):
    _text = CTE[_name][1]
    for _old, _new in (("fct_match", "long_match"), ("fct_training", "long_training"),
                       ("FROM match_weeks", "FROM long_match_weeks"), ("JOIN training_weeks", "JOIN long_training_weeks"),
                       ("FROM weeks", "FROM long_weeks"), ("FROM parts", "FROM long_parts"), ("FROM score", "FROM long_score")):
        _text = _text.replace(_old, _new)
    cte(f"long_{_name}", _needs, _text)

_SCORE = ("player_id", "score_week", "development_score", "weighted_win_rate", "avg_technique_score",
          "avg_break_point_conversion", "matches_played", "matches_won", "sessions_completed", "avg_shots_per_hour")


@query(with_ctes(f"SELECT {', '.join(_SCORE)} FROM long_score", "long_score"))
def long_development_score(t: Tables) -> DataFrame:
    return marts.development_score(order_matches(t), shipped_days(t)).select(*_SCORE)


@query(with_ctes("SELECT * EXCLUDE (player_sk) FROM long_digest", "long_digest"))
def long_weekly_digest(t: Tables) -> DataFrame:
    return marts.weekly_digest(marts.development_score(order_matches(t), shipped_days(t))).drop("player_sk")


@query(with_ctes("SELECT * FROM long_report", "long_report"))
def long_monthly_report(t: Tables) -> DataFrame:
    """Days of training are stored before score and report read them, as in a build."""
    matches, training = order_matches(t), sinks.materialize(shipped_days(t), scratch_dir(t.spark, "training"))
    return marts.monthly_report(matches, training, marts.development_score(matches, training))


@query(with_ctes("SELECT * FROM long_report", "long_report"))
def report_in_increments(t: Tables) -> DataFrame:
    """Two runs over a growing history, the second rewriting few months, give the report of one run."""
    folder = scratch_dir(t.spark, "report")
    matches = sinks.materialize(order_matches(t), f"{folder}/matches")
    training = sinks.materialize(shipped_days(t), f"{folder}/training")
    for until in ("1998-01-15", "2100-01-01"):
        seen, trained = matches.filter(F.col("match_date") < until), training.filter(F.col("session_date") < until)
        report = build.refresh_report(
            seen, trained, marts.development_score(seen, trained), f"{folder}/report")
    return report.drop("calculated_at").withColumn("report_month", F.col("report_month").cast("string"))
