"""What several operators share: stored intermediate tables, words and remote files."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from podium.session import scratch_dir

BATCH_ROWS = 512
_SHIPPED: set[str] = set()
# White space of the contracts: 0x20 and 0x09-0x0D, which is also what bytes.split() splits at.
WORD = r"[^\x20\x09-\x0D]+"


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows depends on files that all nodes reach, so a lost executor costs no more than the
    tasks it was running, and nothing above is worked out twice.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return text.encode().lower().split() if text else []


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; a plain path or any URI that Arrow knows."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[6:7] != "/" else path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: bounds what a task holds besides one batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def ship(spark: SparkSession) -> None:
    """Hand this package to the session's Python workers, once per application.

    Spark serves the archive from the driver, so workers need neither a shared source folder nor a
    particular working directory. Batches to them are limited to ``BATCH_ROWS`` rows: with the
    default of 10,000, a run of very long texts would not fit a worker.
    """
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="podium-code-")  # served by the driver while the application runs
    context.addPyFile(shutil.make_archive(f"{folder}/podium_code", "zip", os.path.dirname(package), os.path.basename(package)))
