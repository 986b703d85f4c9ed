"""Event-time loads: repeats are dropped, and rows that come too late go to a table of their own.

How far time has come is the highest event time of earlier batches, kept by batch number beside the
checkpoint. A batch that is replayed after a failure therefore decides as it did the first time, and a restart
goes on where the last run ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators.changes import unseen
from podium.session import scratch_dir
from podium.sources.readers import table, table_or_empty
from podium.sources.sinks import append, insert_new, materialize
from podium.streaming.intake import run_available_now

_MARKS = "batch_id bigint, high timestamp"


def distinct_within(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row of each key within the watermark, for sinks that can't be asked what they hold.

    The state keeps a key until the watermark has passed its time and ``delay``, so its size follows the delay, not
    the age of the stream. Rows behind the watermark are dropped, see :func:`ingest_in_time` to keep them.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def ingest_in_time(stream: DataFrame, target: str, late: str, checkpoint: str, keys: Sequence[str], event_time: str,
                   delay: str, order: Sequence[str | Column]) -> None:
    """Drain ``stream``: rows in time to ``target``, once per key; overdue ones and those without a time to ``late``.

    Overdue is what lies more than ``delay`` (an interval such as ``5 days``) before the highest time of all
    earlier batches. ``target`` is stored by the day of the event; its key index tells which days may hold a key.
    """
    run_available_now(stream, split_batches(target, late, f"{checkpoint.rstrip('/')}-marks", keys, event_time, delay, order),
                      checkpoint)


def split_batches(target: str, late: str, marks: str, keys: Sequence[str], event_time: str, delay: str,
                  order: Sequence[str | Column]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = materialize(batch, scratch_dir(spark, "batch"))  # read several times below
        seen = spark.createDataFrame([], _MARKS).schema
        earlier = table_or_empty(spark, marks, seen).filter(F.col("batch_id") < batch_id)
        limit = earlier.agg((F.max("high") - F.expr(f"INTERVAL {delay}")).alias("limit")).scalar()
        in_time = F.coalesce(F.col(event_time).isNotNull() & (limit.isNull() | (F.col(event_time) >= limit)), F.lit(False))
        judged = materialize(staged.withColumns({"_in_time": in_time, "event_day": F.to_date(event_time)}), scratch_dir(spark, "judged"))
        insert_new(judged.filter("_in_time").drop("_in_time"), target, keys, order, ["event_day"], indexed=True)
        insert_new(judged.filter("NOT _in_time").drop("_in_time", "event_day"), late, keys, order)
        mark = staged.agg(F.lit(batch_id).cast("bigint").alias("batch_id"), F.max(event_time).cast("timestamp").alias("high"))
        append(unseen(mark, table_or_empty(spark, marks, seen), ["batch_id"], ["high"]), marks)
    return write


def stored_in_time(spark: SparkSession, target: str) -> DataFrame:
    """The target without the column it is stored by."""
    return table(spark, target).drop("event_day")
