"""Writers. A target is a catalog table name or a Parquet folder."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.changes import keyless, unseen
from podium.operators.joins import new_only, sized
from podium.session import scratch_dir
from podium.sources import key_index, versions
from podium.sources.key_index import in_partitions, partitions_of
from podium.sources.readers import is_path, table, table_exists

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of the partition of null


def overwrite(df: DataFrame, target: str, partition_by: Sequence[str] = (),
              cluster_by: Sequence[str] = ()) -> None:
    """Create or replace the whole table. ``df`` must not read from ``target``."""
    _save(df, target, "overwrite", "static", partition_by, cluster_by)


def append(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows; they may bring columns the table lacks, see ``read_parquet(merge_schema=True)``."""
    _save(df, target, "append", "static", partition_by)


def materialize(df: DataFrame, target: str, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = ()) -> DataFrame:
    """Write a model and read it back under the schema it was written with."""
    overwrite(df, target, partition_by, cluster_by)
    return table(df.sparkSession, target, df.schema)


def publish(df: DataFrame, target: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
            keep: int = 2) -> DataFrame:
    """Replace the whole table in one step and return the new version.

    The rows, which may be read from ``target`` itself, go to a folder of their own, and the table changes when that is
    whole (see ``versions``). A reader sees the old rows or the new ones, and goes on reading what it began with;
    the last ``keep`` versions stay. A write that fails leaves the table as it was; if another writer published
    meanwhile, this one fails. ``target`` is a folder; a plain one becomes a published one, its old files unread.
    """
    spark = df.sparkSession
    if not is_path(target):
        raise ValueError(f"{target}: only folders have versions")
    if keep < 1:
        raise ValueError("the current version has to be kept")
    last = max(versions.numbers(spark, target), default=0)
    version = versions.draft(target)
    rows = materialize(df, version, partition_by, cluster_by)
    versions.record(spark, target, version, last)
    versions.retire(spark, target, keep)
    return rows


def insert_new(df: DataFrame, target: str, keys: Sequence[str], order: Sequence,
               partition_by: Sequence[str] = (), rejects: str | None = None, indexed: bool = False) -> None:
    """Idempotent insert: a key is written once, however often its batch is replayed.

    Rows that lack part of their key go to the table ``rejects``, equal ones once, where it is named. With
    ``indexed``, a stored index of the keys (see ``key_index``) tells which values of the first partition column may hold a
    key of the batch, and only those partitions are read; without, the keys of the whole table are.
    """
    spark = df.sparkSession
    existing = table(spark, target) if table_exists(spark, target) else None
    if indexed:
        batch = materialize(unseen(df, None, keys, order), scratch_dir(spark, "batch"))
        fresh = batch
        if existing is not None:
            known = materialize(key_index.stored_rows(batch, target, keys, partition_by[0]).select(*keys), scratch_dir(spark, "known"))
            fresh = materialize(new_only(batch, sized(known), keys), scratch_dir(spark, "fresh"))
        key_index.extend(fresh, target, keys, partition_by[0])
        append(fresh, target, partition_by)
    else:
        append(unseen(df, None if existing is None else sized(existing), keys, order), target, partition_by)
    if rejects is not None:
        insert_new(keyless(df, keys), rejects, ["reject_id"], ["reject_id"])


def replace(df: DataFrame, target: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Replace the whole table by rows that may be read from it.

    They are staged in the shared folder first, where they stay should the write fail.
    """
    overwrite(materialize(df, scratch_dir(df.sparkSession, "replacement")), target, partition_by, cluster_by)


def upsert_partitions(changes: DataFrame, target: str, keys: Sequence[str], partition: str,
                      deleted: str | None = None) -> None:
    """Upsert that reads and rewrites only the partitions the changes fall into.

    A key must keep its partition value, as the week and month tables do: their keys are made of
    it; :func:`apply_changes` takes keys that move. ``deleted`` names a column that is true for rows that take
    their key out of the table. Dynamic mode stages the files and swaps partition folders on commit, so the folder
    being read stays intact until then.
    """
    spark = changes.sparkSession
    # The changes are used several times below; they are worked out once.
    staged = materialize(changes, scratch_dir(spark, "changes"))
    live = staged if deleted is None else staged.filter(F.coalesce(~F.col(deleted), F.lit(True))).drop(deleted)
    if not table_exists(spark, target):
        append(live, target, [partition])
        return
    _rewrite(staged.select(*keys, partition), keys, live, target, partition)


def apply_changes(changes: DataFrame, target: str, keys: Sequence[str], partition: str,
                  deleted: str = "_deleted") -> DataFrame:
    """Upsert of keys that may move between partitions or go; returns the stored rows they replace or remove.

    ``changes`` has one row per key; where ``deleted`` is true, only the key counts. The index of keys (see
    ``key_index``) tells which partitions may hold them, so neither the search for the old rows nor the rewrite
    reads any other. What is returned has been stored before the rewrite.
    """
    spark = changes.sparkSession
    staged = materialize(changes, scratch_dir(spark, "changes"))
    live = staged.filter(F.coalesce(~F.col(deleted), F.lit(True))).drop(deleted)
    if not table_exists(spark, target):
        key_index.extend(live, target, keys, partition)
        append(live, target, [partition])
        return live.limit(0)
    before = materialize(key_index.stored_rows(staged, target, keys, partition), scratch_dir(spark, "before"))
    key_index.extend(live, target, keys, partition)
    _rewrite(before.select(*keys, partition), keys, live, target, partition)
    return before


def replace_grains(fresh: DataFrame, touched: DataFrame, target: str, grain: Sequence[str], partition: str) -> None:
    """Make ``fresh`` all that ``target`` holds of the ``touched`` grains; a grain without fresh rows is gone.

    ``touched`` has the columns of ``grain`` and ``partition``, which depends on the grain. No other partition is read or rewritten.
    """
    spark = fresh.sparkSession
    staged = materialize(fresh, scratch_dir(spark, "fresh"))
    if table_exists(spark, target):
        _rewrite(touched, grain, staged, target, partition)
    else:
        append(staged, target, [partition])


def _rewrite(going: DataFrame, match: Sequence[str], live: DataFrame, target: str, partition: str) -> None:
    """Swap the partitions of ``going`` and ``live``: rows that match ``going`` or ``live`` leave, ``live`` enters."""
    spark = live.sparkSession
    left, entered = partitions_of(going, partition), partitions_of(live, partition)
    leaving = sized(going.select(*match).unionByName(live.select(*match)), going.count() + live.count()).distinct()
    stored = table(spark, target).select(live.columns)

    def kept(values: Sequence[str | None]) -> DataFrame:
        return new_only(in_partitions(stored, partition, values), leaving, match)

    values = list(dict.fromkeys([*left, *entered]))
    emptied = [v for v in left if v not in entered]
    if emptied:  # dynamic mode only swaps folders that get rows
        holding = partitions_of(kept(emptied), partition)
        emptied = [v for v in emptied if v not in holding]
    _save(kept(values).unionByName(live), target, "overwrite", "dynamic", [partition])
    _drop_partitions(spark, target, partition, emptied)


def _drop_partitions(spark: SparkSession, target: str, partition: str, values: Sequence[str | None]) -> None:
    if not values:
        return
    if not is_path(target):
        for value in values:
            told = "NULL" if value is None else "'" + value.replace("'", "''") + "'"
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (`{partition}` = {told})")
        return
    gone = {_NULL_FOLDER if v is None else v for v in values}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(versions.current(spark, target))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        name, _, value = entry.getPath().getName().partition("=")
        if name == partition and unquote(value) in gone:
            files.delete(entry.getPath(), True)


def _save(df: DataFrame, target: str, mode: str, partitions: str, partition_by: Sequence[str],
          cluster_by: Sequence[str] = ()) -> None:
    """Rows of a partition value are brought together first, which avoids one small file per task
    and value; AQE splits a value that is too large for one file. ``cluster_by`` orders the rows
    inside each file, so that min/max statistics prune on those columns.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        whole = mode == "overwrite" and partitions == "static"
        place = target if whole else versions.current(df.sparkSession, target)
        writer.option("partitionOverwriteMode", partitions).parquet(place)
    elif partitions == "dynamic":
        _insert_partitions(df, target)
    else:  # an option here would become one of the table's own
        writer.format("parquet").saveAsTable(target)


def _insert_partitions(df: DataFrame, target: str) -> None:
    """Replace the partitions of a catalog table that ``df`` has rows for.

    A table may not be read by its own overwrite, so the rows are staged; inserts heed the session's mode alone.
    """
    staged = materialize(df, scratch_dir(df.sparkSession, "partitions"))
    conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        staged.select(df.sparkSession.table(target).columns).write.insertInto(target, overwrite=True)
    finally:
        conf.set(mode, before)
