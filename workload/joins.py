"""Join, set and incremental-filter operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.scalars import week_start, year_month
from podium.operators import changes, joins
from podium.schemas import ALIAS_SEED
from podium.sources.readers import rows_to_df
from workload.registry import query
from workload.sql import n, week, ym
from workload.tables import Tables

_SEGMENTS = [
    {"alias": " Building ", "canonical_player_id": "construction", "alias_source": "list"},
    {"alias": "AUTOMOBILE", "canonical_player_id": "cars", "alias_source": "list"},
    {"alias": "machinery", "canonical_player_id": "machines", "alias_source": "list"},
    {"alias": "Machinery", "canonical_player_id": "engines", "alias_source": "list"},
]


@query("""
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'AUTOMOBILE' THEN 'cars'
                      WHEN 'MACHINERY' THEN 'engines' ELSE lower(c_mktsegment) END AS c_mktsegment
    FROM customer""")
def alias_resolution(t: Tables) -> DataFrame:
    """Padded and doubly declared aliases; unmapped names fall back to themselves."""
    seed = rows_to_df(t.spark, _SEGMENTS, ALIAS_SEED)
    return joins.resolve_alias(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", seed)


def _days(t: Tables, kind: str, day: str) -> DataFrame:
    return (t.events.filter(F.col("event_type") == kind)
            .groupBy("user_id", F.to_date("ts").alias(day)).agg(F.count(F.lit(1)).alias(f"{kind}s")))


_CLICK_DAYS = "SELECT user_id, CAST(ts AS DATE) AS click_day, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY ALL"


@query(f"""
    SELECT c.user_id, click_day, clicks, purchase_day, purchases
    FROM ({_CLICK_DAYS}) c
    LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS purchase_day, count(*) AS purchases
               FROM events WHERE event_type = 'purchase' GROUP BY ALL) p
      ON c.user_id = p.user_id AND purchase_day BETWEEN click_day AND click_day + 7""")
def forward_window(t: Tables) -> DataFrame:
    """Every purchase day within a week of a click day, at day grain."""
    return joins.forward_window_join(
        _days(t, "click", "click_day"), _days(t, "purchase", "purchase_day"),
        "user_id", "click_day", "purchase_day", 7)


@query("""
    SELECT l.user_id, l.click_day, p.event_id, p.purchase_day, p.value,
           CAST(p.purchase_day - l.click_day AS INTEGER) AS days_ahead
    FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS click_day FROM events WHERE event_type = 'click') l
    LEFT JOIN (SELECT *, CAST(ts AS DATE) AS purchase_day FROM events WHERE event_type = 'purchase') p
      ON l.user_id = p.user_id AND p.purchase_day BETWEEN l.click_day AND l.click_day + 7
    QUALIFY row_number() OVER (PARTITION BY l.user_id, l.click_day
                               ORDER BY p.purchase_day NULLS LAST, p.event_id) = 1""")
def nearest_purchase(t: Tables) -> DataFrame:
    clicks = (t.events.filter(F.col("event_type") == "click")
              .select("user_id", F.to_date("ts").alias("click_day")).distinct())
    purchases = t.events.filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id", F.to_date("ts").alias("purchase_day"), "value")
    return joins.nearest_following(clicks, purchases, "user_id", "click_day", "purchase_day", 7,
                                   ["event_id"], "days_ahead")


def _weeks(t: Tables, kind: str) -> DataFrame:
    return (t.events.filter(F.col("event_type") == kind)
            .groupBy("user_id", week_start("ts").alias("week")).agg(F.count(F.lit(1)).alias(f"{kind}s")))


@query(f"""
    SELECT user_id, week, views, errors
    FROM (SELECT user_id, {week('ts')} AS week, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY ALL)
    FULL JOIN (SELECT user_id, {week('ts')} AS week, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY ALL)
    USING (user_id, week)""")
def full_outer_weeks(t: Tables) -> DataFrame:
    """Both sides are already grouped on the join keys, so the join adds no shuffle."""
    return joins.full_outer_coalesce(_weeks(t, "view"), _weeks(t, "error"), ["user_id", "week"])


@query(f"""
    SELECT o_custkey, report_month, n_orders, n_items
    FROM (SELECT o_custkey, {ym('o_orderdate')} AS report_month, count(*) AS n_orders FROM orders GROUP BY ALL)
    LEFT JOIN (SELECT o_custkey, {ym('l_shipdate')} AS report_month, count(*) AS n_items
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
    USING (o_custkey, report_month)""")
def shipped_in_order_month(t: Tables) -> DataFrame:
    """Left outer join on two keys."""
    ordered = (t.orders.groupBy("o_custkey", year_month("o_orderdate").alias("report_month"))
               .agg(F.count(F.lit(1)).alias("n_orders")))
    shipped = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
               .groupBy("o_custkey", year_month("l_shipdate").alias("report_month"))
               .agg(F.count(F.lit(1)).alias("n_items")))
    return ordered.join(shipped, ["o_custkey", "report_month"], "left")


@query("""SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def new_orders(t: Tables) -> DataFrame:
    """A load that overlaps the table it goes into: only unseen keys remain."""
    incoming = t.orders.filter(F.col("o_orderdate") >= "1998-01-01")
    existing = t.orders.filter(F.col("o_orderdate") < "1999-01-01")
    return joins.new_only(incoming, existing, ["o_orderkey"])


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 0)")
def not_reviewed(t: Tables) -> DataFrame:
    """The exclusion list holds nulls, which must not empty the result."""
    reviewed = t.labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("doc_id"))
    return joins.not_reviewed(t.documents.select("doc_id", "lang"), reviewed, "doc_id")


@query(f"""
    SELECT {ym('l_shipdate')} AS report_month, count(*) AS items, {n('sum(l_quantity)')} AS quantity
    FROM lineitem
    WHERE {ym('l_shipdate')} IN (SELECT {ym('o_orderdate')} FROM orders WHERE o_orderpriority = '1-URGENT')
    GROUP BY 1""")
def reported_months(t: Tables) -> DataFrame:
    """Semi join on a computed key; the month list is as long as the calendar at most."""
    months = (t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
              .select(year_month("o_orderdate").alias("report_month")).distinct())
    items = t.lineitem.withColumn("report_month", year_month("l_shipdate"))
    return (items.join(months, "report_month", "left_semi").groupBy("report_month")
            .agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").cast("bigint").alias("quantity")))


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
    WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) - 90 FROM orders
                                       WHERE o_orderdate < TIMESTAMP '2000-01-01')""")
def newer_orders(t: Tables) -> DataFrame:
    """High-water filter with a look-back of ninety days for late rows."""
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    target = dated.filter(F.col("order_day") < "2000-01-01")
    return changes.newer_than(dated, "order_day", target, "order_day", F.date_sub("_high", 90))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders")
def newer_than_nothing(t: Tables) -> DataFrame:
    """An empty target lets every row through."""
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    return changes.newer_than(dated, "order_day", dated.limit(0), "order_day")


@query("SELECT DISTINCT user_id FROM events WHERE event_type IN ('view', 'error')")
def union_distinct(t: Tables) -> DataFrame:
    def users(kind: str) -> DataFrame:
        return t.events.filter(F.col("event_type") == kind).select("user_id")
    return users("view").union(users("error")).distinct()
