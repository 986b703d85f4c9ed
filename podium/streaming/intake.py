"""Drain-and-stop loads: every available file is processed once, then the query ends.

The batch function inserts unseen keys only, so a batch replayed after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.text import parse_session_files, valid_session_file
from podium.operators.conform import conform, enrich_intake, with_lineage
from podium.plans.bronze import valid_students
from podium.schemas import RAW_STUDENTS, SESSION_FILES
from podium.session import scratch_dir
from podium.sources.readers import stream_binary, stream_csv
from podium.sources.sinks import insert_new, materialize


def run_available_now(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (stream.writeStream.foreachBatch(batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def insert_batches(target: str, keys: Sequence[str], order: Sequence[str | Column],
                   partition_by: Sequence[str] = (), rejects: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function that inserts unseen keys and skips an empty batch; the batch is worked out once."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        staged = materialize(batch, scratch_dir(batch.sparkSession, "batch"))
        if not staged.isEmpty():
            insert_new(staged, target, keys, order, partition_by, rejects)
    return write


def ingest_students(spark: SparkSession, folder: str, target: str, checkpoint: str,
                    version: str = "v1.0", glob: str = "students.csv") -> None:
    """Student CSV drops, one row per ``student_id``, partitioned by age group."""
    raw = stream_csv(spark, folder, RAW_STUDENTS, glob).select("*", "_metadata.file_path")
    rows = with_lineage(valid_students(raw), F.col("file_path"), version, ["student_id"]).drop("file_path")
    run_available_now(
        rows, insert_batches(target, ["student_id"], ["submitted_at", "intake_id"], ["age_group"]), checkpoint)


def ingest_intake(events: DataFrame, target: str, checkpoint: str, version: str = "v1.0",
                  now: Column | None = None, rejects: str | None = None) -> None:
    """Intake events, one row per ``intake_id``: the first one submitted; those without go to ``rejects``."""
    rows = enrich_intake(events, version, now)
    run_available_now(
        rows, insert_batches(target, ["intake_id"], ["submitted_at", *_tie(events)], rejects=rejects), checkpoint)


def ingest_session_files(spark: SparkSession, folder: str, target: str, checkpoint: str,
                         version: str = "v1.0", glob: str = "*.png") -> None:
    """Page images: metadata from the file name, the image itself is never read into the table."""
    rows = session_file_rows(stream_binary(spark, folder, glob).drop("content"), version)
    run_available_now(rows, insert_batches(target, ["_record_hash"], ["_source_file"]), checkpoint)


def session_file_rows(files: DataFrame, version: str, now: Column | None = None) -> DataFrame:
    """Same parsing for a batch and a stream of files."""
    parsed = valid_session_file(parse_session_files(files))
    sized = parsed.withColumn("file_size_bytes", F.col("length").cast("bigint"))
    return conform(with_lineage(sized, F.col("path"), version, ["path"], now), SESSION_FILES)


def _tie(df: DataFrame) -> list[str]:
    return [c for c in ("kafka_partition", "kafka_offset") if c in df.columns]
