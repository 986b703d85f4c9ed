"""Prefix trie of conversations: which beginnings they share, and what a prefix cache would save.

The turns of a conversation, as identifiers of (role, text), fill columns ``t1..tN`` of a block; longer
conversations go on in further blocks. A block's key stands for all turns before it, so one GROUP BY over
(block, key, ROLLUP(t1..tN)) counts the prefixes of every length and block together, and ``grouping_id``
tells their length. Counts combine in the map tasks: a beginning that a third of all conversations share
is one partial row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import stored
from podium.llm.digests import EMPTY, ordered_sha256
from podium.operators.joins import lookup
from podium.operators.windows import global_rank

COLUMNS = 8
_ROOT = "0:0"


def _halves(sha: Column) -> list[Column]:
    """Two numbers below 2^60 from a hexadecimal SHA-256."""
    return [F.conv(F.substring(sha, start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16)]


def _told(block: str, turns: list[str]) -> Column:
    """SHA-256 of a block's number and its turns; columns without a turn are left out."""
    return F.sha2(F.concat_ws("|", F.col(block).cast("string"), *turns), 256)


def _key(sha: Column) -> Column:
    """Key of a prefix: sums of its blocks' numbers, which the block number inside the hash keeps in order."""
    return F.concat_ws(":", *[(F.col(p) + h).cast("string") for p, h in zip(("p1", "p2"), _halves(sha))])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the beginning of the first of its five: (conv_id, turns) and (conv_id, depth, turn).

    Conversation c takes the first h turns of c - c % 5 and then its own after the first h, where h is the
    CRC-32 of c's digits modulo 9. ``turn`` identifies role and text and ends in the text's bytes.
    """
    bare = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("content"),
        F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"))
    ranked = global_rank(bare, ["conv_id", F.col("turn").asc_nulls_first(), "role", "content"]).select(
        "conv_id", "rank", F.concat(F.sha2(F.concat("content", "role"), 256), F.lit(":"), "bytes").alias("turn"))
    own = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("own"))
    own = own.select("*", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h"),
                     (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    lenders = own.select(F.col("conv_id").alias("base"), F.col("own").alias("lends"))
    plan = stored(own.join(lenders, "base", "left").withColumn(
        "lent", F.least("h", F.coalesce("lends", F.lit(0)))), "rebuilding")
    placed = lookup(ranked, plan.select("conv_id", "first", "h", "lent"), ["conv_id"]).withColumn(
        "place", F.col("rank") - F.col("first") + 1)
    placed = stored(placed, "placed")
    later = placed.filter("place > h").select("conv_id", (F.col("lent") + F.col("place") - F.col("h")).alias("depth"), "turn")
    heads = placed.filter("place <= 8").select(F.col("conv_id").alias("base"), "place", "turn")  # h is 8 at most
    taken = (heads.join(plan.select("conv_id", "base", "h"), "base").filter("place <= h")
             .select("conv_id", F.col("place").alias("depth"), "turn"))
    members = plan.select("conv_id", (F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"))
    return members, later.unionByName(taken)


def _rollup(blocks: DataFrame, names: list[str], **measures: str) -> DataFrame:
    """All prefixes within all blocks at once: ``measures`` per (block, p1, p2, t1..tN), nulls beyond ``level``.

    ``level`` is the prefix's length within its block and ``depth`` its whole length; ``last`` is its last turn. Shorter
    conversations fill their missing columns with nulls, whose groups repeat the prefix and are left out.
    """
    rolled = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(names)}, {len(names)} - bit_count(grouping_id()) AS level, "
        + ", ".join(f"{expr} AS {alias}" for alias, expr in measures.items())
        + " FROM {blocks} GROUP BY block, p1, p2, ROLLUP(" + ", ".join(names) + ")", blocks=blocks)
    last = F.expr(f"try_element_at(array({', '.join(names)}), level)")
    return (rolled.filter("level > 0").withColumn("last", last).filter(F.col("last").isNotNull())
            .withColumn("depth", F.col("block") * len(names) + F.col("level")))


def prefix_trie(members: DataFrame, turns: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """Nodes of the trie over ``members`` (conv_id, turns) and ``turns`` (conv_id, depth from 1, turn).

    A turn is a string that identifies it and ends in ``:`` and the bytes of its text. Per node, the root
    (depth 0) included: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes in its subtree, itself included), ``saved_tokens`` (over its subtree,
    bytes of the node's turn times members but one) and ``ends_sha256`` (ids of the members that end
    there, ascending, joined by commas). No members give no nodes; members without turns end at the root.

    Sums over a subtree need no walk. Its smallest member owns a node, so the nodes a conversation owns
    are the end of its path, from where it leaves all smaller ids on. Bytes and leaves owned are summed
    over a node's members by the same ROLLUP; only of the node's own smallest member the part above the node is taken off.
    """
    names = [f"t{i}" for i in range(1, columns + 1)]
    slot = (F.col("depth") - 1) % columns + 1
    size = F.substring_index("turn", ":", -1).cast("long")
    blocks = (turns.withColumn("block", F.floor((F.col("depth") - 1) / columns)).groupBy("conv_id", "block")
              .agg(*[F.max(F.when(slot == i, F.col("turn"))).alias(n) for i, n in enumerate(names, 1)],
                   F.sum(size).alias("bytes"), F.max("depth").alias("upto")))
    halves = [h.alias(n) for n, h in zip(("h1", "h2"), _halves(_told("block", names)))]
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    zero = F.lit(0)
    blocks = stored(blocks.select("*", *halves).select(
        "conv_id", "block", *names, "upto",
        *[F.coalesce(F.sum(h).over(before), zero).cast("decimal(30,0)").alias(p) for h, p in (("h1", "p1"), ("h2", "p2"))],
        F.coalesce(F.sum("bytes").over(before), zero).alias("above"),
        F.sum("bytes").over(whole).alias("total"), F.max("upto").over(whole).alias("turns")), "blocks")

    nodes = _rollup(blocks, names, conv_id="min(conv_id)", longest="max(turns)")
    nodes = nodes.select("conv_id", F.substring_index("last", ":", -1).cast("long").alias("bytes"),
                         (F.col("longest") == F.col("depth")).cast("long").alias("leaf"))
    owners = nodes.groupBy("conv_id").agg(F.sum("bytes").alias("owned"), F.sum("leaf").alias("leaves"))
    weighed = lookup(blocks, owners, ["conv_id"]).fillna(0, ["owned", "leaves"])
    sums = {"n_convs": "count(*)", "totals": "sum(total)", "owned": "sum(owned)", "n_leaves": "sum(leaves)",
            "smallest": "min(struct(conv_id, total, owned))"}
    below = _rollup(weighed, names, **sums, above="min(above)")
    inside = F.expr(f"aggregate(filter(slice(array({', '.join(names)}), 1, level - 1), x -> x IS NOT NULL), "
                    "0L, (s, x) -> s + CAST(substring_index(x, ':', -1) AS BIGINT))")
    upper = [F.when(F.col("level") > i, F.col(n)) for i, n in enumerate(names, 1)]
    below = below.select(
        "depth", _key(_told("block", names)).alias("key"),
        F.when(F.col("level") > 1, _key(F.sha2(F.concat_ws("|", F.col("block").cast("string"), *upper), 256)))
        .otherwise(F.concat_ws(":", F.col("p1").cast("string"), F.col("p2").cast("string"))).alias("parent"),
        "n_convs", "totals", "owned", "n_leaves", "smallest", (F.col("above") + inside).alias("above"))
    ends = weighed.groupBy("conv_id").agg(F.max("total").alias("total"), F.max("owned").alias("owned"),
                                          F.max("leaves").alias("leaves"))
    everyone = members.join(ends, "conv_id", "left").fillna(0, ["total", "owned", "leaves"])
    root = everyone.agg(*[F.expr(e).alias(n) for n, e in sums.items()]).filter("n_convs > 0").withColumn(
        "n_leaves", F.greatest("n_leaves", F.lit(1)))
    root = root.select(F.lit(0).alias("depth"), F.lit(_ROOT).alias("key"), F.lit(None).cast("string").alias("parent"),
                       "n_convs", "totals", "owned", "n_leaves", "smallest", F.lit(0).alias("above"))
    trie = stored(below.unionByName(root), "trie")

    last = blocks.filter("upto = turns").select("conv_id", _key(_told("block", names)).alias("key"))
    silent = members.filter("turns = 0").select("conv_id", F.lit(_ROOT).alias("key"))
    digests = ordered_sha256(last.unionByName(silent).select(
        "key", F.col("conv_id").alias("place"), F.col("conv_id").cast("string").alias("piece")), ",")
    children = trie.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = trie.select(F.col("key").alias("parent"), F.col("smallest.conv_id").alias("parent_conv_id"))
    full = lookup(trie.join(children, "key", "left").join(digests, "key", "left"), parents, ["parent"])
    unique = F.col("owned") - F.col("smallest.owned") + F.col("smallest.total") - F.col("above")
    return full.select(
        F.col("smallest.conv_id").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("totals") - F.col("n_convs") * F.col("above") - unique).cast("long").alias("saved_tokens"),
        F.coalesce("sha256", F.lit(EMPTY)).alias("ends_sha256"))
