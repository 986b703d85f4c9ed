"""Change sets applied to tables, and the history of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.predicates import not_provenance
from podium.operators import changes, joins
from podium.plans import bronze
from podium.schemas import EVAL_SET
from workload.registry import query
from workload.sql import MATCH_STAGED, key, with_ctes
from workload.tables import Tables

_OPEN = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderstatus <> 'P' OR o_orderdate < TIMESTAMP '2000-01-01'""")
def upsert_orders(t: Tables) -> DataFrame:
    """Every open order comes back closed; pending ones of the last years are not known yet."""
    known = t.orders.filter((F.col("o_orderstatus") != "P") | (F.col("o_orderdate") < "2000-01-01"))
    closed = known.filter(F.col("o_orderstatus") == "O").withColumns({
        "o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1})
    return changes.upsert(known.select(*_OPEN), closed.select(*_OPEN), ["o_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS remark
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, o_custkey, 'P', o_totalprice * 2, 'new' FROM orders WHERE o_orderstatus = 'P'""")
def replace_slice(t: Tables) -> DataFrame:
    """The pending slice is replaced by rows that carry one column more."""
    fresh = t.orders.filter(F.col("o_orderstatus") == "P").select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.lit("new").alias("remark"))
    return changes.replace_slice(t.orders.select(*_OPEN), fresh, not_provenance("o_orderstatus", "P"))


@query(with_ctes(f"""
    SELECT {', '.join(MATCH_STAGED)}, sha256(match_id) AS _record_hash FROM raw_match
    WHERE winners >= 0 AND unforced_errors >= 0 AND match_date >= DATE '2024-01-16'""", "raw_match"))
def load_matches(t: Tables) -> DataFrame:
    """A match load in which every row arrives twice and the first half is in the table already."""
    existing = t.raw_matches.filter(F.col("match_date") < "2024-01-16")
    incoming = t.raw_matches.unionByName(t.raw_matches)
    return bronze.ingest_matches(incoming, existing, "events").select(*MATCH_STAGED, "_record_hash")


@query(with_ctes("""
    SELECT session_id, prompt_version, shots_in, NULL AS _pipeline_version FROM raw_training
    WHERE prompt_version <> 'synthetic'
    UNION ALL SELECT session_id, prompt_version, shots_in, 'v2.0' FROM raw_training
    WHERE prompt_version = 'synthetic'""", "raw_training"))
def load_training(t: Tables) -> DataFrame:
    """Generated rows are replaced (arriving twice), extracted ones kept."""
    generated = t.raw_training.filter(F.col("prompt_version") == "synthetic")
    loaded = bronze.ingest_training(generated.unionByName(generated), t.raw_training, "events")
    return loaded.select("session_id", "prompt_version", "shots_in", "_pipeline_version")


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS session_id, text AS raw_note_text, 'neutral' AS sentiment,
           CAST(NULL AS VARCHAR) AS issue
    FROM documents JOIN labels USING (doc_id) WHERE quality = 1
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), text, 'needs_work', CASE WHEN toxic = 1 THEN 'toxic' END
    FROM documents JOIN labels USING (doc_id) WHERE quality = 0""")
def approve(t: Tables) -> DataFrame:
    """Approvals as a typed batch: no text is pasted into SQL, blank answers become null."""
    graded = t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("session_id"), F.col("text").alias("raw_note_text"),
        F.when(F.col("quality") == 1, "neutral").otherwise("needs_work").alias("sentiment"),
        F.when((F.col("quality") == 0) & (F.col("toxic") == 1), "toxic").otherwise("").alias("issue"),
        "quality")
    none = changes.approve(t.spark.createDataFrame([], EVAL_SET), graded.filter("quality = 1"))
    return changes.approve(none, graded.filter("quality = 0")).select(
        "session_id", "raw_note_text", "sentiment", "issue")


@query("""
    SELECT o_orderkey AS finding_id, coalesce(last_status, 'pending') AS coach_status
    FROM orders LEFT JOIN (
        SELECT l_orderkey, max_by(CASE WHEN l_returnflag = 'R' THEN 'dismissed' ELSE 'confirmed' END,
                                  (l_shipdate, l_returnflag <> 'R')) AS last_status
        FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def set_status(t: Tables) -> DataFrame:
    """Line items are the decisions taken on an order; the last one counts."""
    findings = t.orders.select(F.col("o_orderkey").alias("finding_id"), F.lit("pending").alias("coach_status"))
    decisions = t.lineitem.select(
        F.col("l_orderkey").alias("finding_id"), F.col("l_shipdate").alias("decided_at"),
        F.when(F.col("l_returnflag") == "R", "dismissed").otherwise("confirmed").alias("coach_status"))
    return changes.set_status(findings, decisions)


_TRACKED = ("priority", "status")


def _snapshots(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("player_id"), F.to_date("o_orderdate").alias("valid_from"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), "o_orderkey")


_HISTORY = f"""
    SELECT player_id, valid_from, priority, status, o_orderkey,
           lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current,
           {key('player_id', 'valid_from')} AS player_sk
    FROM (SELECT *, lag(priority) OVER d AS old_priority, lag(status) OVER d AS old_status
          FROM (SELECT o_custkey AS player_id, CAST(o_orderdate AS DATE) AS valid_from,
                       o_orderpriority AS priority, o_orderstatus AS status, o_orderkey
                FROM orders
                QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                           ORDER BY o_orderkey DESC) = 1)
          WINDOW d AS (PARTITION BY player_id ORDER BY valid_from))
    WHERE old_priority IS NULL OR (priority, status) <> (old_priority, old_status)
    WINDOW w AS (PARTITION BY player_id ORDER BY valid_from)"""


def _history(t: Tables) -> DataFrame:
    return changes.scd2_history(_snapshots(t), "player_id", _TRACKED, "valid_from", [F.col("o_orderkey").desc()])


@query(_HISTORY)
def scd2_history(t: Tables) -> DataFrame:
    """Validity intervals of a customer's profile, read off all orders."""
    return _history(t)


@query(f"""
    WITH hist AS ({_HISTORY})
    SELECT l_orderkey, l_linenumber, l_partkey, o_custkey AS player_id, CAST(l_shipdate AS DATE) AS ship_day,
           h.player_sk
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN hist h ON h.player_id = o_custkey AND h.valid_from <= CAST(l_shipdate AS DATE)
                    AND (h.valid_to IS NULL OR h.valid_to > CAST(l_shipdate AS DATE))""")
def version_at_day(t: Tables) -> DataFrame:
    """Version of the customer in force when each line item was shipped."""
    facts = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("player_id"),
        F.to_date("l_shipdate").alias("ship_day"))
    dim = _history(t).withColumns({
        "valid_from": F.col("valid_from").cast("timestamp"), "valid_to": F.col("valid_to").cast("timestamp")})
    return joins.version_at(facts, dim, "player_id", "ship_day")


@query(f"""
    WITH before AS (SELECT c_custkey AS player_id, c_mktsegment AS segment, c_nationkey AS nation,
                           TIMESTAMP '2024-01-01' AS valid_from FROM customer WHERE c_nationkey < 20),
         after AS (SELECT c_custkey AS player_id,
                          CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSEHOLD' ELSE c_mktsegment END AS segment,
                          c_nationkey + 100 AS nation FROM customer WHERE c_nationkey >= 5)
    SELECT b.player_id, b.segment, b.nation, {key('b.player_id', 'b.valid_from')} AS player_sk, b.valid_from,
           CASE WHEN a.segment <> b.segment THEN TIMESTAMP '2024-06-01' END AS valid_to,
           coalesce(a.segment = b.segment, true) AS is_current
    FROM before b LEFT JOIN after a USING (player_id)
    UNION ALL
    SELECT a.player_id, a.segment, a.nation, {key('a.player_id', "TIMESTAMP '2024-06-01'")},
           TIMESTAMP '2024-06-01', NULL, true
    FROM after a LEFT JOIN before b USING (player_id) WHERE b.segment IS NULL OR a.segment <> b.segment""")
def scd2_apply(t: Tables) -> DataFrame:
    """Changed profiles are closed and reopened, new ones opened; untracked columns do not count."""
    dim = t.customer.filter("c_nationkey < 20").select(
        F.col("c_custkey").alias("player_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"), F.lit("2024-01-01").cast("timestamp").alias("valid_from"))
    dim = dim.selectExpr(
        "player_id", "segment", "nation", "md5(concat_ws('-', player_id, valid_from)) AS player_sk",
        "valid_from", "CAST(NULL AS timestamp) AS valid_to", "true AS is_current")
    incoming = t.customer.filter("c_nationkey >= 5").select(
        F.col("c_custkey").alias("player_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "HOUSEHOLD").otherwise(F.col("c_mktsegment")).alias("segment"),
        (F.col("c_nationkey") + 100).alias("nation"))
    return changes.scd2_apply(dim, incoming, "player_id", ["segment"],
                              F.lit("2024-06-01").cast("timestamp"), ["nation"])
