"""Projections, filters and text functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions import predicates, scalars, text
from podium.operators.conform import conform, map_fields, with_lineage
from podium.plans import bronze
from podium.schemas import INTAKE_FIELDS, INTAKE_REQUIRED, RAW_MATCHES, declare
from podium.sources.readers import decode_events, query as parameterised
from podium.streaming.intake import session_file_rows
from workload.registry import query
from workload.sql import MATCH_STAGED, key, month, n, percent, ratio, sha, week, with_ctes, ym
from workload.tables import Tables


@query(f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {ratio('l_tax', 'l_discount')} AS tax_to_discount,
           {ratio('l_extendedprice', 'l_quantity', 2)} AS unit_price
    FROM lineitem
    WHERE l_shipdate IS NOT NULL AND l_quantity >= 0 AND l_extendedprice >= 0 AND l_tax BETWEEN 0 AND 0.06""")
def guarded_ratios(t: Tables) -> DataFrame:
    """Null when the denominator is zero; filters on raw columns reach the scan."""
    rows = predicates.require(t.lineitem, ["l_shipdate"])
    rows = rows.filter(predicates.non_negative(["l_quantity", "l_extendedprice"])).filter(F.col("l_tax").between(0, 0.06))
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        scalars.safe_ratio("l_tax", "l_discount").alias("tax_to_discount"),
        scalars.safe_ratio("l_extendedprice", "l_quantity", 2).alias("unit_price"))


@query(f"""
    SELECT o_orderkey, {week('o_orderdate')} AS order_week, {month('o_orderdate')} AS order_month,
           {ym('o_orderdate')} AS order_year_month
    FROM orders""")
def calendar_keys(t: Tables) -> DataFrame:
    keyed = scalars.with_calendar(t.orders, "o_orderdate", "order")
    return keyed.select("o_orderkey", "order_week", "order_month", "order_year_month")


@query(f"""
    SELECT o_orderkey, {key('o_orderkey', 'o_orderstatus')} AS order_sk,
           {sha('o_custkey', "nullif(o_orderstatus, 'P')")} AS order_id
    FROM orders""")
def surrogate_keys(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", scalars.surrogate_key("o_orderkey", "o_orderstatus").alias("order_sk"),
        scalars.deterministic_id("o_custkey", F.nullif("o_orderstatus", F.lit("P"))).alias("order_id"))


@query(with_ctes(f"""
    SELECT event_id, {percent('CASE WHEN k > 0 THEN value / 1000 END')} AS share,
           CASE WHEN least(1, value / 100) < 0.6 THEN 'low'
                WHEN least(1, value / 100) < 0.8 THEN 'medium' ELSE 'high' END AS band,
           CASE event_type WHEN 'purchase' THEN 'Win' WHEN 'error' THEN 'Loss' ELSE '-' END AS result,
           CASE WHEN event_type = 'purchase' THEN 1.0e0 ELSE 0.0e0 END AS win,
           k > 0 AS has_share
    FROM ev""", "ev"))
def display_labels(t: Tables) -> DataFrame:
    share = F.when(F.col("k") > 0, F.col("value") / 1000)
    return t.numbered_events.select(
        "event_id", scalars.percent_label(share).alias("share"),
        scalars.confidence_band(F.least(F.lit(1.0), F.col("value") / 100)).alias("band"),
        scalars.map_values("event_type", {"purchase": "Win", "error": "Loss"}, "-").alias("result"),
        scalars.win_value(F.col("event_type") == "purchase").alias("win"),
        share.isNotNull().alias("has_share"))


@query(with_ctes("""
    SELECT student_id, utr_rating, competition_level FROM raw_student
    WHERE student_id IS NOT NULL AND full_name IS NOT NULL
      AND (utr_rating IS NULL OR utr_rating BETWEEN 0.0 AND 16.5)
      AND (competition_level IS NULL OR competition_level IN ('competitive', 'recreational'))""", "raw_student"))
def valid_students(t: Tables) -> DataFrame:
    return bronze.valid_students(t.raw_students).select("student_id", "utr_rating", "competition_level")


@query(with_ctes(f"""
    SELECT {', '.join(MATCH_STAGED)}, sha256(match_id) AS _record_hash, 'events' AS _source_file,
           'v2.0' AS _pipeline_version
    FROM raw_match
    WHERE match_id IS NOT NULL AND player_id IS NOT NULL AND match_date IS NOT NULL
      AND winners >= 0 AND unforced_errors >= 0""", "raw_match"))
def typed_matches(t: Tables) -> DataFrame:
    """All columns arrive as text, are cast in one projection, checked and given their lineage."""
    text_rows = t.raw_matches.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in RAW_MATCHES.names])
    typed = bronze.valid_matches(conform(text_rows, RAW_MATCHES))
    rows = with_lineage(typed, "events", "v2.0", ["match_id"])
    return rows.select(*MATCH_STAGED, "_record_hash", "_source_file", "_pipeline_version")


# Page file of every event: a good name, an impossible date, no page, a capital extension or an
# underscore inside the player's name.
_STAMP = {"spark": "date_format(ts, 'yyyyMMddHHmm')", "duckdb": "strftime(ts, '%Y%m%d%H%M')"}
_PATH = """concat('dbfs:/raw/screenshots/',
    case when k < 10 then '202599991400' else {stamp} end,
    case when k between 20 and 24 then '_p_' else '_p' end, user_id, '_',
    case when event_type in ('purchase', 'error') then 'match'
         when event_type in ('view', 'click') then 'training' else event_type end,
    case when k between 10 and 14 then '' else concat('_', least(k, 12)) end,
    case when k between 15 and 19 then '.PNG' else '.png' end)"""


def session_files_of(t: Tables) -> DataFrame:
    return t.numbered_events.selectExpr(f"{_PATH.format(stamp=_STAMP['spark'])} AS path", "v AS length", "event_id")


_FILES = f"""
    SELECT *, regexp_extract(path, '([^/]+)\\.png$', 1) AS filename
    FROM (SELECT event_id, v AS length, {_PATH.format(stamp=_STAMP['duckdb'])} AS path FROM ev)"""
# All stamps here have twelve digits, all players a name, and no type goes on.
_PARSED = f"""
    SELECT event_id, path, length, filename,
           CAST(try_strptime(left(filename, 8), '%Y%m%d') AS DATE) AS session_date, substr(filename, 9, 4) AS session_time,
           coalesce(p[2], '') AS player_name, kind AS session_type,
           CASE WHEN p[-2] IN ('match', 'training') THEN TRY_CAST(p[-1] AS INTEGER) END AS page_number,
           concat_ws('_', left(filename, 12), coalesce(p[2], ''), kind) AS session_id
    FROM (SELECT *, CASE WHEN p[3] IN ('match', 'training') THEN p[3] ELSE '' END AS kind
          FROM (SELECT *, string_split(filename, '_') AS p FROM ({_FILES})))"""


@query(with_ctes(_PARSED, "ev"))
def parse_session_files(t: Tables) -> DataFrame:
    return text.parse_session_files(session_files_of(t))


VALID_FILES = f"""
    SELECT session_id, session_date, session_time, player_name, session_type, page_number, filename,
           length AS file_size_bytes, path AS _source_file, 'v1.0' AS _pipeline_version,
           sha256(path) AS _record_hash
    FROM ({_PARSED})
    WHERE session_date IS NOT NULL AND player_name <> '' AND session_type IN ('match', 'training')
      AND page_number IS NOT NULL"""


@query(with_ctes(VALID_FILES, "ev"))
def session_files(t: Tables) -> DataFrame:
    return session_file_rows(session_files_of(t), "v1.0").drop("_ingested_at")


@query(with_ctes("SELECT event_id, k, CAST(NULL AS VARCHAR) AS missing FROM ev", "ev"))
def parse_props(t: Tables) -> DataFrame:
    parsed = t.events.withColumn("p", F.from_json("props", declare("BIGINT k", "STRING missing")))
    return parsed.select("event_id", "p.k", "p.missing")


@query("""
    SELECT event_id AS kafka_offset, CAST(user_id AS INTEGER) AS kafka_partition,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events""")
def decode_bus_events(t: Tables) -> DataFrame:
    raw = t.events.select(
        F.col("props").cast("binary").alias("value"), F.col("event_id").alias("offset"),
        F.col("user_id").cast("int").alias("partition"))
    return decode_events(raw, declare("BIGINT k"))


_BLANK = "' ' || chr(9) || chr(13) || chr(10)"
_FENCED = "CASE WHEN lang = 'en' THEN '```json' || chr(10) || text || chr(10) || '```' ELSE text END"


@query(f"""
    SELECT doc_id, CASE WHEN starts_with(body, '```') THEN trim(array_to_string(list_filter(
               string_split(body, chr(10)), lambda l: NOT starts_with(trim(l, {_BLANK}), '```')), chr(10)), {_BLANK})
           ELSE body END AS answer
    FROM (SELECT doc_id, trim({_FENCED}, {_BLANK}) AS body FROM documents)""")
def strip_fences(t: Tables) -> DataFrame:
    fenced = F.when(F.col("lang") == "en", F.concat(F.lit("```json\n"), "text", F.lit("\n```"))).otherwise(F.col("text"))
    return t.documents.select("doc_id", text.strip_fences(fenced).alias("answer"))


@query("SELECT page_id, to_base64(encode(html)) AS content, replace(url, 'https:', '') AS address FROM pages")
def encode_pages(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id", text.encode_content(F.col("html").cast("binary")).alias("content"),
        text.strip_scheme("url", "https:").alias("address"))


@query("""
    SELECT o_orderpriority, count(*) AS orders_from_day FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderstatus = 'F' GROUP BY 1""")
def parameterised_query(t: Tables) -> DataFrame:
    """Text with named parameters instead of values pasted into it."""
    t.orders.createOrReplaceTempView("podium_orders")
    return parameterised(
        t.spark, """SELECT o_orderpriority, count(*) AS orders_from_day FROM podium_orders
                    WHERE o_orderdate >= CAST(:first_day AS TIMESTAMP) AND o_orderstatus = :status
                    GROUP BY o_orderpriority""", first_day="1997-01-01", status="F")


# Answers to an intake form: the required ones are missing now and then.
_ANSWERS = {
    "field_001": "case when k > 2 then concat('Player ', user_id) end",
    "field_003": "concat('p', user_id)",
    "field_004": "'2012-05-01'",
    "field_005": "case when k < 60 then cast(least(k, 16) as string) end",
    "field_006": "'Right'",
    "field_008": "cast(k as string)",
    "field_009": "case when v > 0 then cast(least(v, 7) as string) end",
    "field_014": "'Parent'",
    "field_015": "concat('p', user_id, '@example.org')",
}


def intake_answers(t: Tables) -> DataFrame:
    signups = t.numbered_events.filter(F.col("event_type") == "signup")
    pairs = [part for name, sql in _ANSWERS.items() for part in (F.lit(name), F.expr(sql))]
    return signups.select("event_id", "ts", "user_id", F.create_map(*pairs).alias("answers"))


INTAKE_SQL = """
    SELECT event_id, {columns}
    FROM ev WHERE event_type = 'signup' AND k > 2 AND v > 0"""


@query(with_ctes(INTAKE_SQL.format(columns=", ".join(
    f"{_ANSWERS.get(f, 'CAST(NULL AS VARCHAR)').replace('as string', 'as varchar')} AS {c}"
    for f, c in INTAKE_FIELDS.items())), "ev"))
def intake_form(t: Tables) -> DataFrame:
    mapped = map_fields(intake_answers(t), "answers", INTAKE_FIELDS, INTAKE_REQUIRED)
    return mapped.select("event_id", *INTAKE_FIELDS.values())


@query(with_ctes(f"SELECT {n('sum(k)')} AS total, count(*) AS kept FROM ev WHERE value / 100 < 0.8", "ev"))
def low_confidence(t: Tables) -> DataFrame:
    scored = t.numbered_events.withColumn("extraction_confidence", F.col("value") / 100)
    return scored.filter(predicates.below_confidence(0.8)).agg(
        F.sum("k").alias("total"), F.count(F.lit(1)).alias("kept"))


