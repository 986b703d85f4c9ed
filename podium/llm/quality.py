"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates.

A text is a run of tokens: words in lower case, runs of other signs by themselves, a mark before a word in capitals,
and a mark in place of a word that repeats the one before. Tokens and pairs of neighbours are hashed into
``BUCKETS`` columns; a text is the vector of their counts, brought to length 1, plus a constant. Nothing but
the text enters a score.

Training (McMahan et al., "Ad Click Prediction", 2013) takes a bounded sample of labelled texts: about ``SAMPLE``
distinct texts of each label, those with the smallest hashes, so every label's rows have the same chance at
any size. Rows are worked into sparse features in parallel and stored; each pass over them is one ordered task, whose
state is two numbers a bucket. Scores are sparse dot products with the weights that are not zero, at most one
a bucket, which travel with the function.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import slices, stored

BUCKETS = 1 << 18
SAMPLE = 6_000      # distinct texts of each label, about; a bound on what is fitted, not on what is scored
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
CUT = 0.7
HELD_OUT = 2        # remainder of crc32(doc_id) modulo 4
_REMEMBERED = 100_000
_PIECE = re.compile(r"[^\W_]+|[\W_]+")
_CAPITALS, _AGAIN = zlib.crc32(b"\x00capitals"), zlib.crc32(b"\x00again")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of the tokens of a word (what stands between white space), as far as remembered."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _REMEMBERED:
            self.clear()
        hashes = []
        for piece in _PIECE.findall(word):
            if piece.isalpha() and piece.isupper() and len(piece) > 1:
                hashes.append(_CAPITALS)
            hashes.append(zlib.crc32(piece.lower().encode("utf-8", "surrogatepass")))
        if len(word) < 64:
            self[word] = tuple(hashes)
        return tuple(hashes)


def features(text: str | None, words: _Words, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, ascending, and values of a text's tokens and pairs; empty for a text without words."""
    hashes, before = [], None
    for word in (text or "").split():
        if word == before:
            hashes.append(_AGAIN)
        else:
            hashes.extend(words[word])
        before = word
    if not hashes:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    single = np.array(hashes, np.uint64)
    pairs = single[:-1] * _MIX + single[1:]
    both = np.concatenate([single, pairs]) * _MIX
    found, counts = np.unique((both >> np.uint64(32)) % np.uint64(buckets), return_counts=True)
    values = counts / np.sqrt(np.dot(counts, counts))
    return found.astype(np.int32), values.astype(np.float32)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def learn(z: np.ndarray, n: np.ndarray, at: np.ndarray, values: np.ndarray, label: int) -> None:
    """One FTRL update of the state (z, n) by one row; ``at`` holds distinct buckets."""
    w = _weights(z[at], n[at])
    slope = (_sigmoid(float(np.dot(w, values))) - label) * values
    grown = n[at] + slope * slope
    z[at] += slope - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
    n[at] = grown


def _sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-min(max(x, -500.0), 500.0))))


def _with_constant(at: np.ndarray, values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return np.append(at, np.int32(buckets)), np.append(values, np.float32(1))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this id are kept from training; ids that are null have no labels and are not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``text``, ``label`` and ``place`` of about ``sample`` distinct texts of each label.

    Ids that are null, held out, or labelled both ways teach nothing, nor do labels other than 0 and 1. Texts that repeat
    count once a label; a null text is empty.
    """
    told = (labels.filter(F.col("doc_id").isNotNull() & ~held_out() & F.col(label).isin(0, 1))
            .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
            .filter("label = other").select("doc_id", "label"))
    hashed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("content", F.sha2("text", 256))
    # Only hashes are joined with the labels and counted; of the texts, the drawn ones alone leave their task.
    known = stored(hashed.select("doc_id", "content").join(told, "doc_id").select("label", "content").distinct(), "labelled")
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    # The first 15 digits of the hash are evenly spread below 16^15.
    place = F.conv(F.substring("content", 1, 15), 16, 10).cast("double") / float(16 ** 15)
    drawn = stored(known.join(sizes, "label").filter(place * F.col("rows") < float(sample)).select("label", "content"), "drawn")
    return (hashed.select("content", "text").join(drawn, "content").groupBy("label", "content").agg(F.first("text").alias("text"))
            .select("text", "label", F.col("content").alias("place")))


_SPARSE = "place string, label int, at array<int>, value array<float>"


def train(rows: DataFrame, buckets: int = BUCKETS, passes: int = PASSES) -> np.ndarray:
    """Weights of ``buckets`` columns and the constant from ``rows`` (text, label, place), in order of place.

    No rows give weights of zero, so every score is 0.5.
    """
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in slices(batches, 64):
            found = [features(t, words, buckets) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "place": batch.column("place"), "label": batch.column("label").cast(pa.int32()),
                "at": pa.array([at for at, _ in found], pa.list_(pa.int32())),
                "value": pa.array([v for _, v in found], pa.list_(pa.float32()))})

    data = stored(rows.mapInArrow(sparse, _SPARSE), "features")
    state = [np.zeros(buckets + 1), np.zeros(buckets + 1)]
    for _ in range(passes):
        z0, n0 = state

        def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z, n = z0.copy(), n0.copy()
            for batch in slices(batches, 64):
                for label, at, value in zip(batch.column("label").to_pylist(), batch.column("at"), batch.column("value")):
                    learn(z, n, *_with_constant(at.values.to_numpy(), value.values.to_numpy(), buckets), label)
            yield pa.record_batch({"z": pa.array([z.tobytes()]), "n": pa.array([n.tobytes()])})

        done = data.repartition(1).sortWithinPartitions("place").mapInArrow(one_pass, "z binary, n binary").first()
        if done is None:  # no rows at all
            break
        state = [np.frombuffer(done[0]), np.frombuffer(done[1])]
    return _weights(*state)


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row; empty and null texts have the constant's score."""
    buckets = len(weights) - 1
    used = np.flatnonzero(weights).astype(np.int32)
    kept = weights[used].astype(np.float32)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, words = np.zeros(buckets + 1, np.float64), _Words()
        table[used] = kept
        for batch in slices(batches, 64):
            out = []
            for text in batch.column("text").to_pylist():
                at, values = _with_constant(*features(text, words, buckets), buckets)
                out.append(_sigmoid(float(np.dot(table[at], values))))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(out, pa.float64())})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scored, "doc_id long, score double")


def quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``cut`` on) of every document.

    One row per row of ``documents``, also for repeated or null ids; other columns are ignored. With no documents there
    are no rows; with no labels to learn from every score is 0.5.
    """
    weights = train(training_rows(documents, labels, sample=sample))
    return score(documents, weights).select("doc_id", held_out().alias("held_out"), "score",
                                            (F.col("score") >= cut).cast("int").alias("predicted"))
