"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from podium.llm.common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.lines import line_dedup
    return line_dedup(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.licenses import license_scan
    return license_scan(_table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.minhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.warc import round_trip
    return round_trip(_table(spark, sf_dir, "pages"), least_bytes=0)


def op5_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.embeddings import near_vectors
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.decontamination import contaminated
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.languages import identify
    return identify(_table(spark, sf_dir, "documents"), declared="lang", host="source")


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fusion on raw pages: the markup's language, and host and suffix of the address; languages of ``documents``."""
    from podium.llm.languages import fitted, identify_pages
    documents = _table(spark, sf_dir, "documents")
    return identify_pages(_table(spark, sf_dir, "pages"), *fitted(documents.selectExpr("text", "lower(lang) AS label")))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from podium.llm.tokens import write_and_read
    return write_and_read(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.sharding import shard_documents
    return shard_documents(_table(spark, sf_dir, "documents"), shards=24)


def moved_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of op9 edited for one more shard and stored as version 2."""
    from podium.llm.sharding import moved_documents
    return moved_documents(_table(spark, sf_dir, "documents"), shards=24, grown=25)


def op10_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.mixing import mix
    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.repair import repair_report
    return repair_report(_table(spark, sf_dir, "conversations"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.quality import quality
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.llm.prefixes import prefix_trie, rebuilt
    return prefix_trie(*rebuilt(_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_license_scan, op3_minhash, op4_warc, op5_subspace_join,
                            op6_decontamination, op7_language, op8_token_ids, op9_virtual_slots, op10_water_filling,
                            op11_conversation_repair, op12_quality, op13_prefix_trie, pages_language, moved_slots)
}

# Components by a recursive walk over links; both queries below end in it.
_REACHED = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT a AS node, a AS seen FROM both_ways UNION
            SELECT r.node, w.b FROM reached r JOIN both_ways w ON r.seen = w.a),
roots AS (SELECT node, min(seen) AS root FROM reached GROUP BY node)
"""



def _crc32(text: str) -> str:
    """CRC-32 in SQL, bit by bit: a byte is above 255 to tell it from the eight steps that follow it."""
    steps = ("flatten(list_transform(range(strlen({0})), lambda i: list_concat([256 + ord_byte(i)], [0, 0, 0, 0, 0, 0, 0, 0])))"
             .replace("ord_byte(i)", "CAST('0x' || hex(encode({0}))[2 * i + 1:2 * i + 2] AS BIGINT)").format(text))
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], {steps}), lambda c, b: CASE WHEN b > 0 THEN xor(c, b - 256) "
            "WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))")


_EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

ORACLE: dict[str, str] = {
    "op11_conversation_repair": f"""
WITH RECURSIVE arcs(state, initial, letter, target, cost, role) AS (VALUES
  (0, 's', 'K', 1, 0, NULL), (0, 'u', 'K', 2, 0, NULL), (1, 'u', 'K', 2, 0, NULL), (2, 'a', 'K', 3, 0, NULL), (3, 'u', 'K', 2, 0, NULL),
  (0, NULL, 'R', 2, 3, 'user'), (1, NULL, 'R', 2, 3, 'user'), (2, NULL, 'R', 3, 3, 'assistant'), (3, NULL, 'R', 2, 3, 'user'),
  (0, NULL, 'D', 0, 4, NULL), (1, NULL, 'D', 1, 4, NULL), (2, NULL, 'D', 2, 4, NULL), (3, NULL, 'D', 3, 4, NULL)),
inserts(state, n, target, roles) AS (VALUES (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []), (0, 1, 2, ['user']), (1, 1, 2, ['user']),
  (2, 1, 3, ['assistant']), (3, 1, 2, ['user']), (0, 2, 3, ['user', 'assistant']), (1, 2, 3, ['user', 'assistant'])),
drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
faults AS (SELECT *, CASE WHEN rtrim(text, e' \t\n\x0b\f\r') = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(rtrim(text, e' \t\n\x0b\f\r'), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed),
walk(conv_id, i, state, cost, audit, turns) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM faults
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.audit, best.turns FROM (
    SELECT w.conv_id, f.i, a.target AS state, min({{'cost': w.cost + 3 * n.n + a.cost
          + CASE WHEN a.letter <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
        'audit': w.audit || repeat('I', n.n) || a.letter,
        'turns': list_concat(w.turns, list_transform(n.roles, lambda r: r || ':'),
          CASE WHEN a.letter = 'D' THEN [] ELSE [coalesce(a.role, f.role) || ':' || f.text] END)}}) AS best
    FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN inserts n ON n.state = w.state
    JOIN arcs a ON a.state = n.target AND (a.letter = 'D' OR f.fault IN ('fine', 'truncated'))
      AND (a.initial IS NULL OR a.initial = f.role[1])
    GROUP BY w.conv_id, f.i, a.target)),
ended AS (SELECT w.conv_id, min({{'cost': w.cost + 3 * n.n, 'audit': w.audit || repeat('I', n.n),
    'turns': list_concat(w.turns, list_transform(n.roles, lambda r: r || ':'))}}) AS best
  FROM walk w JOIN (SELECT conv_id, max(i) AS i FROM faults GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i
  JOIN inserts n ON n.state = w.state AND n.target IN (0, 3) GROUP BY w.conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.turns, e'\n'), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_prefix_trie": f"""
WITH turns AS (SELECT conv_id, list(sha256(sha256(coalesce(text, '')) || coalesce(role, '')) || ':' || strlen(coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lent AS (SELECT *, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM turns),
rebuilt AS (SELECT l.conv_id, list_concat(coalesce(b.own, [])[1:l.h], l.own[l.h + 1:]) AS turns
  FROM lent l LEFT JOIN turns b ON b.conv_id = l.base),
members AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, d = len(turns) AS ends
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
    CASE WHEN any_value(depth) = 0 THEN 0 ELSE CAST(split_part(prefix[-1], ':', 2) AS BIGINT) END AS bytes FROM members GROUP BY prefix),
children AS (SELECT prefix[1:-2] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (SELECT up AS prefix, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (WHERE childless) AS leaves
  FROM (SELECT n.*, c.n_children IS NULL AS childless, unnest(list_transform(range(depth + 1), lambda d: n.prefix[1:d])) AS up
        FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix) GROUP BY up)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.prefix = n.prefix LEFT JOIN children c ON c.prefix = n.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[1:-2]""",
    "op3_minhash": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, least(len(w), 1)))) AS i FROM words)),
sizes AS (SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingles s USING (doc_id) GROUP BY d.doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
{_REACHED}
SELECT s.doc_id, s.n AS n_shingles, coalesce(r.root, s.doc_id) AS component_id,
  s.doc_id = coalesce(r.root, s.doc_id) AS kept
FROM sizes s LEFT JOIN roots r ON r.node = s.doc_id""",
    "op5_subspace_join": f"""
WITH RECURSIVE usable AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.93),
{_REACHED}
SELECT e.vec_id, (SELECT count(*) FROM both_ways w WHERE w.a = e.vec_id) AS n_links,
  coalesce(r.root, e.vec_id) AS component_id, e.vec_id = coalesce(r.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN roots r ON r.node = e.vec_id""",
    "op10_water_filling": """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, CAST(sum(sum(size)) OVER () AS BIGINT) AS total
  FROM sized GROUP BY source),
filled AS (SELECT *, 3 * source_size AS cap,
    3 * source_size * sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      <= w * (total - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped
  FROM per WINDOW f AS (ORDER BY 3 * source_size / CAST(w AS DOUBLE), source NULLS LAST)),
goal AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE CAST(w AS DOUBLE)
      * CAST(total - coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0) AS DOUBLE)
      / CAST(sum(w) FILTER (WHERE NOT capped) OVER () AS DOUBLE) END AS target FROM filled),
reps AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
running AS (SELECT s.*, r.source_size, r.target, r.whole,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place) AS cum,
    sum(s.size) OVER (PARTITION BY s.source, s.place) AS tied
  FROM sized s JOIN reps r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies
FROM (SELECT *, whole + CASE WHEN whole < 3 AND 2 * cum - tied <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END
  AS copies FROM running)""",
}
