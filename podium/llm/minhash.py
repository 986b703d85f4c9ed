"""Near-duplicate documents by b-bit MinHash.

Every distinct set of word shingles gets 160 minima under seeded permutations. Bands of five minima are
the buckets of candidate generation; of each minimum only its two low bits are kept, packed into bit
planes, so the similarity of a pair is estimated from one popcount and corrected for chance collisions.
Pairs that pass the estimate are confirmed on their full shingle sets.

Groups are never paired off. Documents with equal sets fall into one class first. In a bucket one class
is the hub of a star, and all classes of other components are compared with it; a second round takes
further hubs. Classes that the stars left in different components are then compared with one
another, but only links confirmed on the full sets leave that join, so its result is short however large
a bucket is. A band finds a pair of similarity 0.8 with probability 0.33, all 32 miss it with 3e-6; the
estimate's cut lies five standard deviations below the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import mixed, slices, stored, words_of
from podium.llm.components import components

MINIMA, BANDS, BITS = 160, 32, 2
ROUNDS = ((0,), (1, 2))  # hubs per round
PLANE = 3  # 64-bit words per bit plane: 160 bits and 32 that are always 0
_REMEMBERED = 1 << 16


def _word_hashes() -> dict:
    class Hashes(dict):
        def __missing__(self, word: bytes) -> int:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = found = xxhash.xxh64_intdigest(word)
            return found
    return Hashes()


def shingle_set(words: list[bytes], k: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; fewer words are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(ids))
    total = np.full(len(ids) - k + 1, k, np.uint64)
    for j in range(k):
        total = mixed(total + ids[j:len(ids) - k + 1 + j])
    return np.unique(total)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return (rng.integers(0, 1 << 32, MINIMA, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, MINIMA, np.uint32))


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each permutation, in pieces that stay in the CPU's cache."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 1024):
        values = low[start:start + 1024, None] * factors + shifts
        np.minimum(least, values.min(axis=0), out=least)
    return least


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and set, told apart by the band's number."""
    grouped = minima.reshape(len(minima), BANDS, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2])
    for j in range(grouped.shape[2]):
        keys = mixed(keys + grouped[:, :, j])
    return keys.view(np.int64)


def scrambled(values: np.ndarray) -> np.ndarray:
    """Scrambles 32-bit integers, one to one."""
    values = (values ^ (values >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    values = (values ^ (values >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return values ^ (values >> np.uint32(16))


def low_bits(minima: np.ndarray) -> np.ndarray:
    """The low bits of all scrambled minima as bit planes, ``BITS * PLANE`` 64-bit words per set.

    The low bits of a * x + b depend on those of x alone: unscrambled, two values that agree there would
    do so under every permutation, and chance collisions of small sets would not be independent.
    """
    minima, planes = scrambled(minima), []
    for bit in range(BITS):
        bits = np.zeros((len(minima), PLANE * 64), np.uint8)
        bits[:, :MINIMA] = (minima >> np.uint32(bit)) & np.uint32(1)
        planes.append(np.packbits(bits, axis=1).view(">i8").astype(np.int64))
    return np.concatenate(planes, axis=1)


def profiles(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (null for an empty set), ``bits`` and ``bands`` per row."""
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (factors, shifts) = _word_hashes(), _permutations()
        for batch in slices(batches):
            sizes, keys, minima = [], [], np.full((batch.num_rows, MINIMA), 0xFFFFFFFF, np.uint32)
            for i, text in enumerate(batch.column(1)):
                shingles = shingle_set(words_of(text.as_py()), shingle_words, hashes)
                sizes.append(len(shingles))
                keys.append(hashlib.md5(shingles.tobytes()).digest() if len(shingles) else None)
                if len(shingles):
                    minima[i] = signature(shingles, factors, shifts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 _lists(low_bits(minima)), _lists(band_keys(minima))],
                ["doc_id", "n_shingles", "set_key", "bits", "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        profile, "doc_id bigint, n_shingles bigint, set_key binary, bits array<bigint>, bands array<bigint>")


def _lists(table: np.ndarray) -> pa.Array:
    ends = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(table.reshape(-1)))


def sets_of(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``set_key`` and ``shingles`` of every row that has any."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _word_hashes()
        for batch in slices(batches):
            found = [shingle_set(words_of(t.as_py()), shingle_words, hashes) for t in batch.column(0)]
            found = [s for s in found if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.md5(s.tobytes()).digest() for s in found], pa.binary()),
                 pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["set_key", "shingles"])

    return docs.select("text").mapInArrow(work, "set_key binary, shingles array<bigint>")


def estimate(left: Column, right: Column) -> Column:
    """Similarity from the shares of equal low bits, corrected for those equal by chance."""
    differ = None
    for word in range(PLANE):
        planes = [left[b * PLANE + word].bitwiseXOR(right[b * PLANE + word]) for b in range(BITS)]
        either = planes[0]
        for plane in planes[1:]:
            either = either.bitwiseOR(plane)
        differ = F.bit_count(either) if differ is None else differ + F.bit_count(either)
    chance = 2.0 ** -BITS
    return ((MINIMA - differ) / F.lit(float(MINIMA)) - chance) / (1 - chance)


def estimate_cut(threshold: float) -> float:
    """Five standard deviations of the estimate below the threshold."""
    chance = 2.0 ** -BITS
    equal = chance + (1 - chance) * threshold
    return threshold - 5 * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs of ``a``, ``b`` whose full sets share enough."""
    left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb") - F.col("shared")
    return (pairs.join(left, "a").join(right, "b").withColumn("shared", shared)
            .filter(100 * F.col("shared") >= percent * union).select("a", "b"))


def _sets_for(keys: DataFrame, found: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """Full sets of the classes in ``keys``, each worked out from the text of one of its documents."""
    one = (found.filter(F.col("doc_id").isNotNull()).join(keys, "set_key", "left_semi")
           .groupBy("set_key").agg(F.min("doc_id").alias("doc_id")))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(one.select("doc_id"), "doc_id", "left_semi")
    sets = sets_of(texts, shingle_words).join(keys, "set_key", "left_semi")
    return stored(sets.groupBy("set_key").agg(F.first("shingles").alias("shingles")), "sets")


def _sides(rows: DataFrame, *of_right: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` twice, column names ending in _a and _b."""
    return (rows.select(*[F.col(c).alias(f"{c}_a") for c in rows.columns]),
            rows.select(*[F.col(c).alias(f"{c}_b") for c in of_right or rows.columns]))


def _live(classes: DataFrame, cut: float) -> DataFrame:
    """Classes in their buckets (``band``, its ``place``), as far as the estimate gives them a partner there.

    Bands are paired with bits only after those with one class are gone.
    """
    members = classes.select("set_key", F.posexplode("bands").alias("place", "band"))
    full = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = members.join(full, "band").join(classes.select("set_key", "bits"), "set_key")
    left, right = _sides(stored(buckets, "buckets"), "band", "set_key", "bits")
    likely = ((left["band_a"] == right["band_b"]) & (F.col("set_key_a") != F.col("set_key_b"))
              & (estimate(F.col("bits_a"), F.col("bits_b")) >= cut))
    return (left.join(right, likely, "left_semi")
            .select(*[F.col(f"{c}_a").alias(c) for c in ("band", "place", "n", "set_key", "bits")]))


def _apart(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members of those buckets that hold several components, with their ``root``."""
    if roots is None:
        return buckets.withColumn("root", F.col("set_key"))
    rooted = (buckets.join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
              .withColumn("root", F.coalesce("root", "set_key")))
    several = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y").select("band")
    return rooted.join(several, "band", "left_semi")


def _star(members: DataFrame, turns: tuple[int, ...], cut: float) -> DataFrame:
    """Pairs of each bucket's hubs, one per turn, with the members of other components that the estimate lets pass."""
    hubs = members.groupBy("band").agg(*[
        F.min(F.struct(F.xxhash64("set_key", F.lit(turn)), "set_key", "root", "bits")).alias(f"hub{turn}") for turn in turns])
    hubs = hubs.select("band", F.explode(F.array(*[
        F.struct(*[F.col(f"hub{turn}.{c}") for c in ("set_key", "root", "bits")]) for turn in turns])).alias("hub"))
    return (members.join(hubs, "band")
            .filter((F.col("root") != F.col("hub.root")) & (estimate(F.col("hub.bits"), F.col("bits")) >= cut))
            .select(F.least("hub.set_key", "set_key").alias("a"), F.greatest("hub.set_key", "set_key").alias("b")).distinct())


def _across(members: DataFrame, sets: DataFrame, bands: DataFrame, percent: int, cut: float) -> DataFrame:
    """All links between members of one bucket and different components.

    A pair that shares several bands is confirmed in the first of them only.
    """
    def near(a: DataFrame, b: DataFrame) -> Column:
        return ((a["band_a"] == b["band_b"]) & (F.col("root_a") != F.col("root_b"))
                & (estimate(F.col("bits_a"), F.col("bits_b")) >= cut))

    left, right = _sides(members, "band", "bits", "root")
    open_ones = left.join(right, near(left, right), "left_semi").select(*[F.col(f"{c}_a").alias(c) for c in members.columns])
    left, right = _sides(stored(open_ones, "open").join(sets, "set_key").join(bands, "set_key"))
    before = F.arrays_overlap(F.slice("bands_a", 1, F.col("place_a")), F.slice("bands_b", 1, F.col("place_b")))
    shared = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
    both = F.size("shingles_a").cast("long") + F.size("shingles_b")
    linked = near(left, right) & (F.col("set_key_a") < F.col("set_key_b")) & ~before & (100 * shared >= percent * (both - shared))
    return left.join(right, linked).select(F.col("set_key_a").alias("a"), F.col("set_key_b").alias("b"))


def component_roots(docs: DataFrame, found: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """``node`` and ``root`` of the classes (``set_key``) of stored profiles that have a link."""
    cut = estimate_cut(percent / 100)
    classes = stored(found.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
                     .groupBy("set_key").agg(F.first("bits").alias("bits"), F.first("bands").alias("bands")), "classes")
    live = stored(_live(classes, cut), "live")
    sets = _sets_for(live.select("set_key").distinct(), found, docs, shingle_words)
    roots = None
    for turns in (*ROUNDS, ()):
        # One star settles a bucket of two; from then on only buckets left in several components count.
        active = stored(_apart(live if roots is None else live.filter("n > 2"), roots), "active")
        if roots is not None and active.isEmpty():
            break
        if turns:
            links = _confirmed(stored(_star(active, turns, cut), "star-pairs"), sets, percent)
        else:
            links = _across(active, sets, classes.select("set_key", "bands"), percent, cut)
        if roots is not None:  # what is known of the components stands for the links they came from
            links = links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(links, "a", "b")
    return roots


def near_duplicates(docs: DataFrame, shingle_words: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row.

    Documents are linked when 100 * shared shingles >= ``percent`` * shingles of either. The component's
    id is the smallest ``doc_id`` reachable. A text without words is linked with nothing; so is a row
    without id, whose component and ``kept`` are null. Rows that repeat an id are taken each by its own
    text. An empty table gives no rows; extra columns are not read.
    """
    found = stored(profiles(docs, shingle_words), "profiles")
    roots = component_roots(docs, found, shingle_words, percent)
    rooted = (found.select("doc_id", "n_shingles", "set_key")
              .join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
              .withColumn("root", F.coalesce("root", "set_key")))
    rooted = stored(rooted, "rooted")
    least = (rooted.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
             .filter("n > 1").select("root", "least"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return (rooted.join(least, "root", "left").withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")))


def without_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all their columns, of which one document per group stays.

    Rows that share an id share a decision; rows without id stay.
    """
    dropped = near_duplicates(docs, shingle_words, percent).filter("not kept").select(F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["__dropped"], "left_anti")
