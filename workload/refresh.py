"""Change feeds: rows that move to another month, are taken back or come again, carried through to the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.plans import refresh as plan
from podium.session import scratch_dir
from podium.sources import key_index, readers, sinks
from workload.models import Models
from workload.registry import query
from workload.sql import CTE, with_ctes
from workload.tables import Tables

# Number k of an event: 3 at its end, the event turns out to be 40 days later; 7, it is taken back, but 17 comes again.
_MOVED, _GONE, _BACK = "k % 10 = 3", "k % 10 = 7", "k = 17"


def _changed_sql(sql: str, name: str) -> str:
    """``sql`` over the models of the events as they are after all feeds."""
    events = CTE["ev"][1]
    after = f"""SELECT * REPLACE (CASE WHEN {_MOVED} THEN ts + INTERVAL 40 DAY ELSE ts END AS ts)
    FROM ({events}) WHERE k IS NULL OR NOT {_GONE} OR {_BACK}"""
    return with_ctes(sql, name).replace(f"ev AS ({events})", f"ev AS ({after})")


def _feed(t: Tables, keep: str, shift: int = 0, deleted: bool = False) -> dict[str, DataFrame]:
    """Bronze rows of the events for which ``keep`` holds, as a change feed."""
    part = Tables(t.spark, t.sf_dir)
    later = (F.col("ts") + F.expr(f"INTERVAL {shift} DAY")).cast(dict(t.numbered_events.dtypes)["ts"])
    part.__dict__["numbered_events"] = t.numbered_events.filter(keep).withColumn("ts", later)
    return {"matches": part.raw_matches.withColumn("_deleted", F.lit(deleted)),
            "training": part.raw_training.withColumn("_deleted", F.lit(deleted))}


def _joined(*feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: feeds[0][name].unionByName(feeds[1][name]) for name in feeds[0]}


_DONE: dict[tuple[str, str], dict[str, DataFrame]] = {}  # the queries below read the tables of one run


def _refreshed(t: Tables) -> dict[str, DataFrame]:
    run = (t.spark.sparkContext.applicationId, t.sf_dir)
    if run not in _DONE:
        _DONE[run] = _three_feeds(t)
    return _DONE[run]


def _three_feeds(t: Tables) -> dict[str, DataFrame]:
    m, folder = Models(t), scratch_dir(t.spark, "gold")
    dim = sinks.materialize(m.dim_player, f"{folder}/dim_player")
    aliases = sinks.materialize(m.alias, f"{folder}/aliases")
    plan.refresh(folder, aliases, dim, **_feed(t, "true"))
    plan.refresh(folder, aliases, dim, **_joined(_feed(t, _MOVED, shift=40), _feed(t, _GONE, deleted=True)))
    return plan.refresh(folder, aliases, dim, **_feed(t, _BACK))


def _whole(df: DataFrame, **text: Column) -> DataFrame:
    return df.drop("calculated_at", "score_month").withColumns(text)


@query(_changed_sql("SELECT * FROM report", "report"))
def refreshed_report(t: Tables) -> DataFrame:
    """Matches and sessions move to later months or are taken back: months they leave lose their rows."""
    return _whole(_refreshed(t)["monthly_report"], report_month=F.col("report_month").cast("string"))


@query(_changed_sql("SELECT * FROM digest", "digest"))
def refreshed_digest(t: Tables) -> DataFrame:
    """Weeks that lose all their rows leave the digest, and the week after takes its change from another one."""
    return _whole(_refreshed(t)["weekly_digest"], week_start=F.col("week_start").cast("date"))


@query(_changed_sql("SELECT * FROM score", "score"))
def refreshed_score(t: Tables) -> DataFrame:
    """Scores of the weeks that rows left or entered; weeks across two months read both."""
    return _whole(_refreshed(t)["development_score"])


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'moved' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 7 = 0 THEN '2001-01' ELSE strftime(o_orderdate, '%Y-%m') END AS month
    FROM orders WHERE o_orderkey % 7 <> 1 OR o_orderdate < TIMESTAMP '1998-01-01'""")
def apply_order_changes(t: Tables) -> DataFrame:
    """A feed that moves orders to one month and deletes others, by key alone; whole months vanish with it."""
    target = scratch_dir(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    sinks.apply_changes(rows.withColumn("_deleted", F.lit(False)), target, ["o_orderkey"], "month")
    moved = rows.filter("o_orderkey % 7 = 0").withColumns({"o_orderstatus": F.lit("moved"), "month": F.lit("2001-01")})
    gone = rows.filter("o_orderkey % 7 = 1 AND month >= '1998-01'").withColumns({
        "o_orderstatus": F.lit(None).cast("string"), "month": F.lit(None).cast("string")})
    feed = moved.withColumn("_deleted", F.lit(False)).unionByName(gone.withColumn("_deleted", F.lit(True)))
    sinks.apply_changes(feed, target, ["o_orderkey"], "month")
    return readers.table(t.spark, target).withColumn("month", F.col("month").cast("string"))


@query("SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def replay_with_index(t: Tables) -> DataFrame:
    """Overlapping and repeated loads; which months may hold their keys is asked of the key index."""
    target = scratch_dir(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    sinks.overwrite(rows.filter("month < '1995-01'"), target, ["month"])  # written without an index
    early, late = rows.filter("month < '1999-01'"), rows.filter("month >= '1998-01'")
    for load in (early, late, late.unionByName(late)):
        sinks.insert_new(load, target, ["o_orderkey"], ["o_custkey"], ["month"], indexed=True)
    return readers.table(t.spark, target).withColumn("month", F.col("month").cast("string"))


@query("""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders
    FROM orders WHERE o_orderkey % 500 = 0 GROUP BY 1""")
def months_that_hold(t: Tables) -> DataFrame:
    """Stored rows of some keys, found through the index; the rows, not the index, decide."""
    target = scratch_dir(t.spark, "orders")
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    sinks.overwrite(rows, target, ["month"])
    asked = t.orders.filter("o_orderkey % 500 = 0").select("o_orderkey").unionByName(
        t.orders.select((-F.col("o_orderkey")).alias("o_orderkey")))
    found = key_index.stored_rows(asked, target, ["o_orderkey"], "month")
    return found.groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
