"""Which partitions of a table may hold a key: a stored, append-only index of key hashes.

An entry is the 64-bit hash of a key and the partition its row went to, so asking for keys is one join on the hash,
linear in the keys asked for and the entries. Every batch adds entries of its own; none is ever changed. A key that was
deleted or has moved keeps its old entry, and two keys may share a hash; both cost a needless look and no wrong
answer: what the index names is always checked against the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.operators.joins import sized
from podium.sources.readers import is_path, table, table_exists


def index_of(target: str) -> str:
    return f"{target.rstrip('/')}.keys" if is_path(target) else f"{target}_keys"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def entries(rows: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Entries of the keys of ``rows``: (hash, partition as text)."""
    return rows.dropna(subset=list(keys)).select(
        _hash(keys).alias("key_hash"), F.col(partition).cast("string").alias("partition"))


def extend(rows: DataFrame, target: str, keys: Sequence[str], partition: str) -> None:
    """Add the keys of ``rows``, before the rows themselves are written: an entry too many does no harm."""
    writer = entries(rows, keys, partition).write.mode("append")
    place = index_of(target)
    writer.parquet(place) if is_path(target) else writer.format("parquet").saveAsTable(place)


def ensure(df: DataFrame, target: str, keys: Sequence[str], partition: str) -> None:
    """Index a table that was written without one; reads its keys once."""
    spark = df.sparkSession
    if table_exists(spark, target) and not table_exists(spark, index_of(target)):
        extend(table(spark, target), target, keys, partition)


def holders(rows: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """(keys, ``_partition`` as text) of partitions that may hold a key of ``rows``; never misses one that does."""
    index = table(rows.sparkSession, index_of(target))
    asked = _asked(rows, keys).withColumn("key_hash", _hash(keys))
    return index.join(asked, "key_hash").select(*keys, F.col("partition").alias("_partition")).distinct()


def _asked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sized(rows.select(*keys).dropna()).distinct()


def partitions_of(rows: DataFrame, column: str) -> list[str | None]:
    """Distinct values of a partition column as text: no more than the table has folders."""
    return [r[0] for r in rows.select(F.col(column).cast("string").alias("p")).distinct().collect()]


def in_partitions(df: DataFrame, partition: str, values: Sequence[str | None]) -> DataFrame:
    """Rows of the named partitions. The values are literals of the column's type, so the scan lists no other folder."""
    kind = df.schema[partition].dataType
    named = F.col(partition).isin([F.lit(v).cast(kind) for v in values if v is not None])
    return df.filter(named | F.col(partition).isNull() if None in values else named)


def stored_rows(rows: DataFrame, target: str, keys: Sequence[str], partition: str) -> DataFrame:
    """Rows of ``target`` whose key is among those of ``rows``; only partitions that may hold one are read."""
    spark = rows.sparkSession
    ensure(rows, target, keys, partition)
    named = partitions_of(holders(rows, target, keys), "_partition")
    return in_partitions(table(spark, target), partition, named).join(_asked(rows, keys), list(keys), "left_semi")
