"""Sources, sinks and streams: given tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.scalars import with_calendar
from podium.operators.conform import conform
from podium.plans import build
from podium.schemas import BINARY_FILES, RAW_MATCHES, RAW_STUDENTS, RAW_TRAINING, declare
from podium.session import scratch_dir
from podium.sources import readers, sinks
from podium.streaming import intake, late
from workload.expressions import INTAKE_SQL, VALID_FILES, intake_answers, session_files_of
from workload.models import Models
from workload.registry import query
from workload.sql import n, with_ctes, ym
from workload.tables import Tables


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t: Tables) -> DataFrame:
    folder = scratch_dir(t.spark, "customers-csv")
    t.customer.write.option("header", True).csv(folder)
    schema = declare("BIGINT c_custkey", "STRING c_name", "INT c_nationkey", "DOUBLE c_acctbal", "STRING c_mktsegment")
    return readers.read_csv(t.spark, folder, schema)


@query(f"""
    SELECT {ym('o_orderdate')} AS order_year_month, count(*) AS orders, {n('sum(o_custkey)')} AS customers
    FROM orders WHERE {ym('o_orderdate')} >= '1997-03' GROUP BY 1""")
def partitioned_write(t: Tables) -> DataFrame:
    """Month partitions, one file each while they are small; the filter prunes folders."""
    months = with_calendar(t.orders, "o_orderdate", "order").drop("order_week", "order_month")
    stored = sinks.materialize(months, scratch_dir(t.spark, "orders"), ["order_year_month"], ["o_custkey", "o_orderdate"])
    return (stored.filter(F.col("order_year_month") >= "1997-03").groupBy("order_year_month")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_custkey").alias("customers")))


@query("SELECT * FROM orders")
def insert_twice(t: Tables) -> DataFrame:
    """Overlapping loads, the second one replayed: every order is stored once."""
    target = scratch_dir(t.spark, "orders")
    early, late = (t.orders.filter(F.col("o_orderdate") < "1999-01-01"),
                   t.orders.filter(F.col("o_orderdate") >= "1998-01-01"))
    for load in (early, late, late.unionByName(late)):
        sinks.insert_new(load, target, ["o_orderkey"], ["o_orderdate"])
    return readers.table(t.spark, target)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT DISTINCT NULL, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""")
def insert_without_keys(t: Tables) -> DataFrame:
    """Pending orders arrive without their key, twice: equal ones are kept once, apart from the others."""
    target, rejects = scratch_dir(t.spark, "orders"), scratch_dir(t.spark, "rejects")
    load = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_orderstatus")
    for _ in range(2):
        sinks.insert_new(load, target, ["o_orderkey"], ["o_custkey"], rejects=rejects)
    return readers.table(t.spark, target).unionByName(readers.table(t.spark, rejects).drop("reject_id"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice + 2 AS o_totalprice FROM orders")
def replace_own_input(t: Tables) -> DataFrame:
    """A table replaced twice by rows read from itself."""
    target = scratch_dir(t.spark, "orders")
    sinks.overwrite(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), target, ["o_orderstatus"])
    for _ in range(2):
        raised = readers.table(t.spark, target).withColumn("o_totalprice", F.col("o_totalprice") + 1)
        sinks.replace(raised, target, ["o_orderstatus"])
    return readers.table(t.spark, target).select(
        "o_orderkey", F.col("o_orderstatus").cast("string").alias("o_orderstatus"), "o_totalprice")


@query(with_ctes("SELECT digest_id, player_id, week_start, development_score, score_change, score_trend FROM digest", "digest"))
def digest_in_increments(t: Tables) -> DataFrame:
    """Three runs over growing history give the digest of one full run."""
    m, target = Models(t), scratch_dir(t.spark, "digest")
    scores = sinks.materialize(m.score, scratch_dir(t.spark, "score"))
    for until in ("2024-01-09", "2024-01-16", "2024-12-31"):
        digest = build.refresh_digest(scores.filter(F.col("score_week") < until), target)
    return digest.select(
        "digest_id", "player_id", F.col("week_start").cast("date").alias("week_start"), "development_score",
        "score_change", "score_trend")


@query(with_ctes("SELECT digest_id, player_id, week_start, development_score, score_change, score_trend FROM digest", "digest"))
def digest_with_late_rows(t: Tables) -> DataFrame:
    """Weeks of training alone come late, and scores stored as 0 are corrected, in all of history."""
    m, target = Models(t), scratch_dir(t.spark, "digest")
    scores = sinks.materialize(m.score, scratch_dir(t.spark, "score"))
    early = scores.filter("matches_played > 0")
    build.refresh_digest(early.withColumn(
        "development_score", F.when(F.col("matches_won") > 0, F.col("development_score")).otherwise(0.0)), target)
    return build.refresh_digest(scores, target).select(
        "digest_id", "player_id", F.col("week_start").cast("date").alias("week_start"), "development_score",
        "score_change", "score_trend")


@query(f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND {ym('o_orderdate')} >= '2000-01' THEN 'F'
                            ELSE o_orderstatus END AS o_orderstatus,
           {ym('o_orderdate')} AS month
    FROM orders""")
def upsert_months(t: Tables) -> DataFrame:
    """Only the months that hold changed orders are rewritten."""
    target = scratch_dir(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    sinks.overwrite(rows, target, ["month"])
    closed = rows.filter((F.col("o_orderstatus") == "O") & (F.col("month") >= "2000-01")).withColumn("o_orderstatus", F.lit("F"))
    sinks.upsert_partitions(closed, target, ["o_orderkey"], "month")
    return readers.table(t.spark, target).select("o_orderkey", "o_orderstatus", F.col("month").cast("string").alias("month"))


@query("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders""")
def append_new_column(t: Tables) -> DataFrame:
    """Appended rows may bring a column the table did not have."""
    target = scratch_dir(t.spark, "orders")
    sinks.overwrite(t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus"), target)
    sinks.append(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority"), target)
    return readers.read_parquet(t.spark, target, merge_schema=True)


@query("""
    SELECT 'before' AS seen, o_orderstatus, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY 1, 2
    UNION ALL
    SELECT 'after', 'F', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders WHERE o_orderstatus <> 'P'""")
def read_while_replaced(t: Tables) -> DataFrame:
    """A table is replaced twice by rows made of its own; who opened it before the last time still reads all its old rows."""
    target = scratch_dir(t.spark, "orders")
    sinks.publish(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), target, ["o_orderstatus"])
    early = readers.table(t.spark, target)
    sinks.publish(readers.table(t.spark, target).filter("o_orderstatus <> 'P'"), target)
    late_rows = sinks.publish(readers.table(t.spark, target).withColumn("o_orderstatus", F.lit("F")), target, keep=3)

    def told(seen: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.lit(seen).alias("seen"), F.col("o_orderstatus").cast("string").alias("o_orderstatus")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("o_custkey").alias("customers"))
    return told("before", early).unionByName(told("after", late_rows))


@query("SELECT CAST(count(*) AS BIGINT) AS matches, CAST(0 AS BIGINT) AS training FROM orders")
def table_or_empty(t: Tables) -> DataFrame:
    """A table that is not there yet reads as an empty one."""
    target = scratch_dir(t.spark, "orders")
    sinks.overwrite(t.orders.select(F.col("o_orderkey").cast("string").alias("match_id")), target)
    found = conform(readers.table_or_empty(t.spark, target, RAW_MATCHES), RAW_MATCHES)
    absent = readers.table_or_empty(t.spark, scratch_dir(t.spark, "none"), RAW_TRAINING)
    return found.agg(F.count(F.lit(1)).alias("matches")).withColumn(
        "training", absent.agg(F.count(F.lit(1))).scalar())


@query(with_ctes("""
    SELECT student_id, utr_rating, age_group, competition_level, sha256(student_id) AS _record_hash
    FROM raw_student WHERE utr_rating BETWEEN 0 AND 16.5
      AND competition_level IN ('competitive', 'recreational')""", "raw_student"))
def stream_students(t: Tables) -> DataFrame:
    """CSV drop, drained twice from one checkpoint: the second run finds nothing new."""
    landing, target, checkpoint = (scratch_dir(t.spark, x) for x in ("students", "raw-students", "checkpoint"))
    t.raw_students.unionByName(t.raw_students).write.option("header", True).csv(landing)
    for _ in range(2):
        intake.ingest_students(t.spark, landing, target, checkpoint, glob="*.csv")
    return readers.table(t.spark, target).select(
        "student_id", "utr_rating", F.col("age_group").cast("string").alias("age_group"), "competition_level", "_record_hash")


@query(with_ctes(f"""
    SELECT DISTINCT 'i' || user_id AS intake_id, sha256('i' || user_id) AS student_id,
           'p' || user_id AS preferred_name, true AS is_current, CAST(NULL AS TIMESTAMP) AS valid_to
    FROM ({INTAKE_SQL.format(columns='user_id')})""", "ev"))
def stream_intake(t: Tables) -> DataFrame:
    """Intake events landed in several files, two per micro-batch, one row kept per form."""
    landing, target, checkpoint = (scratch_dir(t.spark, x) for x in ("intake", "raw-students", "checkpoint"))
    forms = intake_answers(t).select(
        F.concat(F.lit("i"), "user_id").alias("intake_id"),
        F.col("answers")["field_001"].alias("full_name"), F.col("answers")["field_003"].alias("preferred_name"),
        F.col("answers")["field_009"].alias("training_frequency_per_week"),
        F.col("ts").cast("string").alias("submitted_at"))
    forms.filter("full_name IS NOT NULL AND training_frequency_per_week IS NOT NULL") \
        .repartition(6, "submitted_at").write.parquet(landing)
    schema = declare("STRING intake_id full_name preferred_name training_frequency_per_week submitted_at")
    events = conform(readers.stream_table(t.spark, landing, schema, files_per_batch=2), RAW_STUDENTS)
    intake.ingest_intake(events, target, checkpoint)
    return readers.table(t.spark, target).select("intake_id", "student_id", "preferred_name", "is_current", "valid_to")


@query(with_ctes(f"SELECT DISTINCT * FROM ({VALID_FILES})", "ev"))
def stream_session_files(t: Tables) -> DataFrame:
    """File listing followed as a stream; same rows as the batch parse, each file once."""
    landing, target, checkpoint = (scratch_dir(t.spark, x) for x in ("files", "raw-files", "checkpoint"))
    files = session_files_of(t).select("path", F.current_timestamp().alias("modificationTime"), "length")
    files.unionByName(files).repartition(4, "path").write.parquet(landing)
    schema = declare(*[f"{f.dataType.simpleString().upper()} {f.name}" for f in BINARY_FILES if f.name != "content"])
    rows = intake.session_file_rows(readers.stream_table(t.spark, landing, schema, files_per_batch=2), "v1.0")
    intake.run_available_now(
        rows, intake.insert_batches(target, ["_record_hash", "file_size_bytes"], ["_source_file"]), checkpoint)
    return readers.table(t.spark, target).drop("_ingested_at")


# Every seventh event is cut short on the bus, and every eleventh arrives without a value.
_ON_THE_BUS = """CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) WHEN event_id % 11 = 0 THEN NULL ELSE props END"""


def _bus(t: Tables) -> DataFrame:
    return t.events.select(F.expr(_ON_THE_BUS).cast("binary").alias("value"), F.col("event_id").alias("offset"),
                           F.col("user_id").cast("int").alias("partition"))


@query(f"""
    SELECT value, CASE WHEN value IS NULL THEN 'no value' ELSE 'not readable' END AS reason, kafka_offset, kafka_partition
    FROM (SELECT {_ON_THE_BUS} AS value, event_id AS kafka_offset, CAST(user_id AS INTEGER) AS kafka_partition FROM events)
    WHERE value IS NULL OR NOT json_valid(value)""")
def rejected_bus_events(t: Tables) -> DataFrame:
    """Records that hold no event, as they came."""
    return readers.decode_or_reject(_bus(t), declare("BIGINT k"))[1]


@query("""
    SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id AS kafka_offset, CAST(user_id AS INTEGER) AS kafka_partition
    FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0""")
def accepted_bus_events(t: Tables) -> DataFrame:
    """What is left of the same records."""
    return readers.decode_or_reject(_bus(t), declare("BIGINT k"))[0]


@query("SELECT c_nationkey, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def catalog_scan(t: Tables) -> DataFrame:
    """A table read by its name in the session's catalog."""
    t.customer.createOrReplaceTempView("customers_by_name")
    rows = readers.table(t.spark, "customers_by_name").filter("c_acctbal > 0")
    return rows.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))


@query("SELECT 'P' || c_custkey AS alias, 'Player-' || c_custkey AS canonical_player_id, c_mktsegment AS alias_source FROM customer")
def seed_file(t: Tables) -> DataFrame:
    """The alias table kept as a CSV file with padded cells."""
    folder = scratch_dir(t.spark, "seed-csv")
    padded = [F.concat(F.lit("  P"), "c_custkey", F.lit(" ")).alias("alias"),
              F.concat(F.lit(" Player-"), "c_custkey").alias("canonical_player_id"), F.col("c_mktsegment").alias("alias_source")]
    (t.customer.select(*padded).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(folder))
    return readers.seed(t.spark, folder)


# Three drops of events: the days before the 20th; the rest with every third event again; and, after a restart, every
# tenth event of the rest, some of them more than five days behind what has been seen.
_DROPS = ("ts < TIMESTAMP '2024-01-20'", "(ts >= TIMESTAMP '2024-01-20' AND event_id % 10 > 0) OR event_id % 3 = 0",
          "ts >= TIMESTAMP '2024-01-20'")
_SEEN = f"SELECT max(ts) - INTERVAL 5 DAY FROM events WHERE {_DROPS[0]} OR {_DROPS[1]}"
_OVERDUE = f"NOT ({_DROPS[0]} OR {_DROPS[1]}) AND ts < ({_SEEN})"


def _in_time(t: Tables) -> tuple[DataFrame, DataFrame]:
    landing, checkpoint = scratch_dir(t.spark, "landing"), scratch_dir(t.spark, "checkpoint")
    target, overdue = scratch_dir(t.spark, "in-time"), scratch_dir(t.spark, "overdue")
    rows = t.events.select("event_id", "ts", "event_type")
    for drops in (_DROPS[:2], _DROPS[2:]):
        for drop in drops:
            rows.filter(drop).coalesce(1).write.mode("append").parquet(landing)
        stream = readers.stream_table(t.spark, landing, rows.schema, files_per_batch=1)
        late.ingest_in_time(stream, target, overdue, checkpoint, ["event_id"], "ts", "5 days", ["ts"])
    return late.stored_in_time(t.spark, target), readers.table(t.spark, overdue)


@query(f"SELECT event_id, ts, event_type FROM events WHERE NOT ({_OVERDUE})")
def stream_in_time(t: Tables) -> DataFrame:
    """Repeated and late events over two runs of a stream: what came in time is stored once."""
    return _in_time(t)[0]


@query(f"""
    SELECT event_id, ts, event_type FROM events
    WHERE (ts >= TIMESTAMP '2024-01-20' AND ts < ({_SEEN}))
       OR (event_id % 3 = 0 AND ts < (SELECT max(ts) - INTERVAL 5 DAY FROM events WHERE {_DROPS[0]}))""")
def stream_overdue(t: Tables) -> DataFrame:
    """What came too late, repeats of stored events among it, kept apart."""
    return _in_time(t)[1]
