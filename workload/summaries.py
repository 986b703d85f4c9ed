"""Aggregates, rankings and rolling windows over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.aggregates import count_where, mean_rounded, ratio_of, spread
from podium.functions.scalars import month_start, year_month
from podium.operators import summaries, windows
from podium.plans import bronze, marts, review
from workload.models import Models
from workload.registry import query
from workload.sql import mean, month, n, rnd, week, with_ctes, ym
from workload.tables import Tables


@query("SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY ALL")
def value_counts(t: Tables) -> DataFrame:
    return summaries.value_counts(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("""
    SELECT count(*) AS total_rows, count(DISTINCT o_orderkey) AS unique_keys,
           count(DISTINCT o_custkey) AS unique_players, min(CAST(o_orderdate AS DATE)) AS first_day,
           max(CAST(o_orderdate AS DATE)) AS last_day
    FROM orders""")
def load_profile(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("day", F.to_date("o_orderdate"))
    return summaries.profile(dated, "o_orderkey", "day", "o_custkey")


@query(with_ctes(f"SELECT {mean('extraction_confidence', 4)} AS avg_confidence FROM raw_match", "raw_match"))
def mean_confidence(t: Tables) -> DataFrame:
    return summaries.mean_confidence(t.raw_matches)


@query(f"""
    SELECT o_custkey, {ym('o_orderdate')} AS report_month, count(*) AS matches_played,
           count(*) FILTER (o_orderstatus = 'F') AS matches_won,
           {rnd("count(*) FILTER (o_orderstatus = 'F') / count(*)", 4)} AS win_rate,
           {mean('o_totalprice', 2)} AS avg_price,
           {rnd('max(o_totalprice) - min(o_totalprice)', 2)} AS price_range,
           {n("sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)")} AS urgent
    FROM orders GROUP BY ALL""")
def monthly_orders(t: Tables) -> DataFrame:
    """Every kind of aggregate the models use, on one grouping."""
    won, rows = count_where(F.col("o_orderstatus") == "F"), F.count(F.lit(1))
    return t.orders.groupBy("o_custkey", year_month("o_orderdate").alias("report_month")).agg(
        rows.alias("matches_played"), won.alias("matches_won"), ratio_of(won, rows).alias("win_rate"),
        mean_rounded("o_totalprice", 2).alias("avg_price"), spread("o_totalprice").alias("price_range"),
        count_where(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query(f"""
    SELECT o_custkey, {month('l_shipdate')} AS ship_month, count(*) AS sessions, {n('sum(l_quantity)')} AS quantity,
           {mean('l_discount', 4)} AS avg_discount, max(l_extendedprice) AS top_price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def monthly_volume(t: Tables) -> DataFrame:
    """Fact joined to its header, then grouped by customer and month."""
    items = t.lineitem.join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.groupBy("o_custkey", month_start("l_shipdate").alias("ship_month")).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("l_quantity").cast("bigint").alias("quantity"),
        mean_rounded("l_discount", 4).alias("avg_discount"), F.max("l_extendedprice").alias("top_price"))


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
           CAST(row_number() OVER w AS INTEGER) AS recency
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
    QUALIFY recency <= 5""")
def latest_orders(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return windows.latest(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5, "recency")


@query(f"""
    SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS wins, count(*) AS matches,
           {rnd("count(*) FILTER (o_orderstatus = 'F') / count(*)", 4)} AS win_rate
    FROM (SELECT * FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 20)
    GROUP BY 1""")
def recent_win_rate(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("won", F.col("o_orderstatus") == "F")
    return summaries.recent_win_rate(
        rows, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], "won", 20)


@query(f"""
    SELECT o_custkey, order_month, spent, lag(spent) OVER w AS before, spent - lag(spent) OVER w AS change
    FROM (SELECT o_custkey, {month('o_orderdate')} AS order_month, {n('sum(round(o_totalprice * 100))')} AS spent
          FROM orders GROUP BY ALL)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY order_month)""")
def change_from_last_month(t: Tables) -> DataFrame:
    monthly = t.orders.groupBy("o_custkey", month_start("o_orderdate").alias("order_month")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("spent"))
    return windows.with_change(monthly, ["o_custkey"], ["order_month"], "spent", "before", "change")


@query("SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders")
def order_by_rank(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return review.order_by_rank(rows, "o_orderpriority", ("1-URGENT", "2-HIGH"),
                                F.col("o_orderdate").desc(), F.col("o_orderkey"))


@query("""
    SELECT o_orderkey, priority, day, row_number() OVER (ORDER BY
             CASE priority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, day DESC NULLS LAST, o_orderkey) AS position
    FROM (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS priority,
                 CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)""")
def position_by_rank(t: Tables) -> DataFrame:
    """The order itself is compared: unknown priorities rank with the rest, unknown days come last."""
    rows = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"),
                           F.when(F.col("o_orderkey") % 11 > 0, F.to_date("o_orderdate")).alias("day"))
    return review.ranked_by(rows, "priority", ("1-URGENT", "2-HIGH"), F.col("day").desc_nulls_last(), F.col("o_orderkey"))


@query(with_ctes(f"""
    SELECT player_id, match_date, day_matches, day_wins,
           {n('sum(day_matches) OVER w')} AS matches_in_window, {n('sum(day_wins) OVER w')} AS wins_in_window,
           {rnd('CAST(sum(day_wins) OVER w AS DOUBLE) / sum(day_matches) OVER w', 4)} AS rolling_win_rate
    FROM (SELECT player_id, match_date, count(*) AS day_matches, count(*) FILTER (player_won) AS day_wins
          FROM stg_match GROUP BY ALL)
    WINDOW w AS (PARTITION BY player_id ORDER BY match_date
                 RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""", "stg_match"))
def rolling_win_rate(t: Tables) -> DataFrame:
    return marts.rolling_win_rate(Models(t).stg_match)


_ISSUE = "case when k < 20 then 'footwork' when k < 45 then 'timing' when k < 70 then 'grip' end"


@query(with_ctes(f"""
    SELECT user_id, week_start, issue AS top_issue, occurrences
    FROM (SELECT user_id, {week('ts')} AS week_start, {_ISSUE} AS issue, count(*) AS occurrences
          FROM ev GROUP BY ALL)
    WHERE issue IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY user_id, week_start ORDER BY occurrences DESC, issue) = 1""", "ev"))
def top_issue(t: Tables) -> DataFrame:
    notes = t.numbered_events.selectExpr("user_id", "CAST(ts AS DATE) AS event_date", f"{_ISSUE} AS issue")
    return marts.top_issue(notes, ["user_id", "week_start"])


@query(with_ctes(f"""
    SELECT player_id, report_month, development_score, lag(development_score) OVER w AS prior_month_score,
           {rnd('development_score - lag(development_score) OVER w', 2)} AS score_vs_last_month
    FROM report WINDOW w AS (PARTITION BY player_id ORDER BY report_month)""", "report"))
def score_vs_last_month(t: Tables) -> DataFrame:
    return marts.score_vs_last_month(Models(t).report).select(
        "player_id", "report_month", "development_score", "prior_month_score", "score_vs_last_month")


_OBSERVED = """
    SELECT concat('m', event_id) AS event_id, 'match' AS event_type,
           case when k < 30 then 'needs_work' when k < 70 then 'neutral' else 'improving' end AS sentiment,
           {confidence} AS extraction_confidence, concat('s', v) AS source_file
    FROM {rows} WHERE event_type IN ('purchase', 'signup') AND k >= 15"""


@query(with_ctes(f"""
    SELECT m.match_id, o.sentiment AS note_sentiment
    FROM fct_match m LEFT JOIN ({_OBSERVED.format(confidence='k', rows='ev')}) o ON o.event_id = m.match_id""",
    "fct_match"))
def note_sentiment(t: Tables) -> DataFrame:
    """Sentiment of the staged note observation on the match fact; observations arrive twice."""
    first = t.spark.sql(_OBSERVED.format(confidence="CAST(k AS DOUBLE)", rows="{rows}"), rows=t.numbered_events)
    again = first.withColumns({"extraction_confidence": F.col("extraction_confidence") - 1, "sentiment": F.lit("neutral")})
    notes = bronze.note_observations(first.unionByName(again))
    return marts.with_note_sentiment(Models(t).fct_match, notes, "match", "match_id").select("match_id", "note_sentiment")


@query(f"""
    SELECT lang, CAST(conv_id AS VARCHAR) AS part_of, pages FROM (
        SELECT c.conv_id, count(*) AS pages, max(d.lang) AS lang
        FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id GROUP BY 1)""")
def pages_per_session(t: Tables) -> DataFrame:
    counts = t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(t.documents.select(F.col("doc_id").alias("conv_id"), "lang"), "conv_id", "left").select(
        "lang", F.col("conv_id").cast("string").alias("part_of"), "pages")
