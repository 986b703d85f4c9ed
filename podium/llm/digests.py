"""SHA-256 of the ordered pieces of every group, however large a group is."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import slices

CHUNK_BYTES = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()


def _joined(separator: bytes, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, parts, size = None, None, [], 0

        def chunk() -> pa.RecordBatch:
            return pa.record_batch({"key": pa.array([key], pa.string()), "place": pa.array([first], pa.int64()),
                                    "piece": pa.array([separator.join(parts)], pa.binary())})
        for batch in slices(batches):
            for k, place, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if parts and (k != key or size >= chunk_bytes):
                    yield chunk()
                    parts, size = [], 0
                if not parts:
                    key, first = k, place
                parts.append(piece)
                size += len(piece) + len(separator)
        if parts:
            yield chunk()
    return run


def _hashed(separator: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def done() -> pa.RecordBatch:
            return pa.record_batch({"key": pa.array([key], pa.string()),
                                    "sha256": pa.array([digest.hexdigest()], pa.string())})
        for batch in slices(batches, 64):
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and k == key:
                    digest.update(separator)
                else:
                    if digest is not None:
                        yield done()
                    key, digest = k, hashlib.sha256()
                digest.update(piece)
        if digest is not None:
            yield done()
    return run


def ordered_sha256(rows: DataFrame, separator: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``key`` and ``sha256`` (lower-case hex) of its pieces in ascending ``place``, joined by ``separator``.

    ``rows`` has ``key`` (string, not null), ``place`` (long, unique within a key) and ``piece``
    (string, not null). Pieces are dealt by ranges of (key, place), so the rows of a hot key spread
    over tasks, which join neighbours into chunks of about ``chunk_bytes``. A digest takes its bytes
    one after another, so the chunks of one key, one row for thousands of short pieces, then pass
    through one task, as a stream: it holds one small batch at a time. A key without rows has no
    row here; the digest of no pieces is ``EMPTY``.
    """
    pieces = rows.select("key", F.col("place").cast("long").alias("place"), F.col("piece").cast("binary").alias("piece"))
    dealt = pieces.repartitionByRange("key", "place").sortWithinPartitions("key", "place")
    chunks = dealt.mapInArrow(_joined(separator.encode(), chunk_bytes), "key string, place long, piece binary")
    return (chunks.repartition("key").sortWithinPartitions("key", "place")
            .mapInArrow(_hashed(separator.encode()), "key string, sha256 string"))
