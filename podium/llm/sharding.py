"""Sharding by fixed virtual slots.

Every record hashes into one of some thousand slots, which never change. A small versioned table maps
slots to shards; only that table is edited when shards are added or have grown apart, so a rebalance
moves whole slots and no record is hashed anew. The law is ``bytes``: shards hold nearly equal sizes.

Everything is DataFrame expressions. The only unbounded step is one shuffle of narrow rows by slot;
the map itself has one row per slot, a number fixed by a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import stored
from podium.session import scratch_dir

SLOTS = 4096
SHARDS = 24


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes plus 8), ``text_crc32`` and ``virtual_slot`` of every row.

    A null text has no bytes. Repeated ids are spread by their texts; rows equal in both are the same record and
    share a slot. Rows without id are spread one by one, so that many of one text do not fill one slot: by their
    position in the scan, which is why these rows are stored before they are counted.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    # A null argument leaves the hash as it is, so only rows without id are placed by their position.
    position = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size", position), F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """Rows and bytes per slot, summed in the map tasks first."""
    return rows.groupBy("virtual_slot").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))


def _placed(moving: Column, loads: Column) -> Column:
    """Largest slot first, each to the shard that holds least: a fold over the sorted slots.

    ``moving`` is an array of (n_bytes, virtual_slot), ``loads`` the bytes every shard starts with.
    """
    def step(state: Column, slot: Column) -> Column:
        shard = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        grown = F.transform(state["loads"], lambda load, i: F.when(i == shard, load + slot["n_bytes"]).otherwise(load))
        placed = F.concat(state["placed"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), shard.alias("shard"))))
        return F.struct(grown.alias("loads"), placed.alias("placed"))

    empty = F.array().cast("array<struct<virtual_slot:int,shard:int>>")
    return F.aggregate(F.sort_array(moving, asc=False), F.struct(loads.alias("loads"), empty.alias("placed")), step)["placed"]


def rebalanced(slot_map: DataFrame | None, sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of the map: ``version``, ``virtual_slot``, ``shard``.

    Every shard keeps its slots, largest first, up to the mean share; what lies above that, and slots
    not yet on the map or on a shard that is gone, are placed anew. Without a map all slots are.
    The map has at most one row per slot, so it may meet in one task. Slots of equal size are taken by the larger
    number first, shards of equal load by the smaller. Without slots there is no map: an empty table gives no rows.
    """
    if slot_map is None:
        held = sizes.withColumn("shard", F.lit(None).cast("int")).withColumn("version", F.lit(0))
    else:
        held = sizes.join(slot_map.select("virtual_slot", "shard", "version"), "virtual_slot", "left").withColumn(
            "shard", F.when(F.col("shard").between(0, shards - 1), F.col("shard")))
    whole = Window.partitionBy()
    largest = Window.partitionBy("shard").orderBy(F.desc("n_bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    held = (held.withColumn("share", F.sum("n_bytes").over(whole) / shards)
            .withColumn("version", F.coalesce(F.max("version").over(whole), F.lit(0)) + 1)
            .withColumn("stays", F.coalesce(F.col("shard").isNotNull() & (F.sum("n_bytes").over(largest) <= F.col("share")),
                                            F.lit(False))))
    load = [F.coalesce(F.sum(F.when(F.col("stays") & (F.col("shard") == i), F.col("n_bytes"))), F.lit(0)) for i in range(shards)]
    entry = F.struct(F.col("n_bytes"), F.col("virtual_slot"))
    kept = F.struct(F.col("virtual_slot"), F.col("shard"))
    gathered = held.agg(F.max("version").alias("version"), F.array(*load).alias("loads"),
                        F.collect_list(F.when(~F.col("stays"), entry)).alias("moving"),
                        F.collect_list(F.when(F.col("stays"), kept)).alias("kept"))
    placed = F.concat(F.col("kept"), _placed(F.col("moving"), F.col("loads")))
    return gathered.select("version", F.explode(placed).alias("slot")).select(
        "version", F.col("slot.virtual_slot").alias("virtual_slot"), F.col("slot.shard").alias("shard"))


def add_version(slot_map: DataFrame, table: str) -> DataFrame:
    """Add a version to the table of maps, a folder per version, and return it as stored.

    Versions are never changed: a reader that names one finds its records where they were. A retried write of the
    same version replaces its folder.
    """
    (slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("version").parquet(table))
    return map_version(slot_map.sparkSession, table)


def map_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """A version of the map, the last one by default; a version that does not exist has no rows."""
    maps = spark.read.schema("virtual_slot int, shard int, version int").parquet(table)
    return maps.filter(F.col("version") == (maps.agg(F.max("version")).scalar() if version is None else F.lit(version)))


def rebalance(sizes: DataFrame, table: str, shards: int) -> DataFrame:
    """Edit the last map for what the slots hold now and for ``shards`` shards, and store it as the next version."""
    return add_version(rebalanced(map_version(sizes.sparkSession, table), sizes, shards), table)


def sharded(rows: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every record with its ``shard`` and its place there, ``slot``, counted from 0 without gaps.

    A record's place is its slot's start in the shard plus its rank within the slot, so no task
    sorts a whole shard.
    """
    within = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (slot_map.join(sizes, "virtual_slot")
              .withColumn("start", F.coalesce(F.sum("n_rows").over(within), F.lit(0)))
              .select("virtual_slot", "shard", "start", "version"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (rows.withColumn("rank", rank).join(starts, "virtual_slot")
            .withColumn("slot", F.col("start") + F.col("rank") - 1))


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, table: str | None = None) -> DataFrame:
    """Shard all rows: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard`` (null under this law), ``virtual_slot`` and the map's ``version``.

    No row is dropped: null ids and texts, repeated rows and empty texts are records like any other.
    An empty table gives no rows. The map becomes version 1 in the folder ``table``, a new one by default.
    """
    rows = stored(records(docs, slots), "records")
    sizes = stored(slot_sizes(rows), "slot-sizes")
    slot_map = add_version(rebalanced(None, sizes, shards), table or scratch_dir(docs.sparkSession, "slot-map"))
    return sharded(rows, slot_map, sizes).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "version")


def moved_documents(docs: DataFrame, shards: int = SHARDS, grown: int = SHARDS + 1, slots: int = SLOTS) -> DataFrame:
    """The same records before and after an edit of the map to ``grown`` shards: ``doc_id``, ``size``, ``virtual_slot``,
    ``shard``, ``new_shard`` and the new ``version``.

    Records are hashed once and joined with a row per slot; only whole slots move. Rows are as in :func:`shard_documents`.
    """
    rows = stored(records(docs, slots), "records")
    sizes = stored(slot_sizes(rows), "slot-sizes")
    table = scratch_dir(docs.sparkSession, "slot-map")
    add_version(rebalanced(None, sizes, shards), table)
    edited = rebalance(sizes, table, grown)
    first = map_version(docs.sparkSession, table, 1).select("virtual_slot", "shard")
    moves = first.join(edited.select("virtual_slot", F.col("shard").alias("new_shard"), "version"), "virtual_slot")
    return rows.join(moves, "virtual_slot").select("doc_id", "size", "virtual_slot", "shard", "new_shard", "version")
