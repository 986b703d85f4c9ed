"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors of cosine c lie at a squared distance of 2 - 2c. After a rotation that spreads the
energy, the vectors are split into blocks of eight dimensions: in at least one block the pair lies
within that block's proportional part of the squared distance. Each block is range-joined on a grid
over its first two dimensions, whose cell is the block's radius times two: one side stays in its own
cell, the other is copied to the cells its square of that radius touches. In a cell both sides are sorted into
tiles by the third dimension, and tiles whose boxes over all eight are too far apart are not compared. The union of what the
blocks find is verified exactly, in double precision, on the original vectors. Nothing is lost: a slack
far above the rounding error covers the joins, the verification has none.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import slices, stored
from podium.llm.components import components
from podium.operators.joins import lookup

COSINE = 0.93
BLOCK_DIMS = 8
HELD = 100_000  # rows of a cell that a task holds
TILE = 128
_SLACK = 1e-9


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A seeded random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _scaled(vector: Column) -> Column:
    """The vector times a power of two that brings its largest component near 1.

    No bit of an ordinary component changes, so neither does a cosine, but squares neither overflow nor vanish.
    """
    largest = F.array_max(F.transform(vector, F.abs))
    power = F.greatest(F.lit(-1000.0), F.least(F.lit(1000.0), -F.floor(F.log2(largest)).cast("double")))
    return F.transform(vector, lambda x: x * F.pow(F.lit(2.0), power))


def classes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors of a label: ``key``, ``label``, ``vector`` (scaled) and ``copies``."""
    rows = vectors.withColumn("vector", F.col("embedding").cast("array<double>"))
    rows = rows.filter(F.col("label").isNotNull() & _usable(F.col("vector")))
    rows = rows.withColumn("vector", _scaled(F.col("vector")))
    return (rows.withColumn("key", _key()).groupBy("key")
            .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies")))


def _key() -> Column:
    """128-bit name of a label and a vector; -0.0 counts as 0.0."""
    numbers = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    return F.md5(F.concat_ws(",", F.col("label").cast("string"), numbers.cast("array<string>")).cast("binary"))


def _squares(column: str) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda total, x: total + x * x)


def _blocks(found: DataFrame, dims: int, cosine: float, block_dims: int) -> tuple[DataFrame, float]:
    """A row per class and block: its coordinates ``x0`` .. there, and the block's squared radius."""
    n_blocks = max(1, dims // block_dims)
    cuts = [dims * b // n_blocks for b in range(n_blocks + 1)]
    widest = max(b - a for a, b in zip(cuts, cuts[1:]))
    matrix = rotation(dims)

    def rotate(batches):
        import pyarrow as pa
        for batch in batches:
            names = batch.schema.names
            flat = batch.column(names.index("vector")).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(batch.num_rows, dims)
            largest = np.abs(vectors).max(axis=1, keepdims=True) if len(vectors) else np.ones((0, 1))
            scaled = vectors / largest  # so that squares neither overflow nor vanish
            turned = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)) @ matrix
            for b, (start, end) in enumerate(zip(cuts, cuts[1:])):
                coords = [turned[:, start + j] if start + j < end else np.zeros(len(turned)) for j in range(widest)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(names.index("key")), batch.column(names.index("label")),
                     pa.array(np.full(len(turned), b, np.int32)), *map(pa.array, coords)],
                    ["key", "label", "block", *(f"x{j}" for j in range(widest))])

    schema = "key string, label string, block int, " + ", ".join(f"x{j} double" for j in range(widest))
    rows = found.select("key", F.col("label").cast("string").alias("label"), "vector").mapInArrow(rotate, schema)
    # A block's part of the squared distance is in proportion to its dimensions.
    return rows, max((2 - 2 * cosine) * (b - a) / dims for a, b in zip(cuts, cuts[1:])) + _SLACK


def _tiles(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the third coordinate, and the boxes of every ``TILE`` points in that order."""
    order = np.argsort(points[:, min(2, points.shape[1] - 1)], kind="stable")
    ordered, starts = points[order], np.arange(0, len(points), TILE)
    return order, np.minimum.reduceat(ordered, starts), np.maximum.reduceat(ordered, starts)


def _within(home: np.ndarray, other: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (home, other) whose squared distance may be within ``budget``; tiles too far apart are passed over."""
    (at, low, high), (bt, blow, bhigh) = _tiles(home), _tiles(other)
    gap = np.maximum(0.0, np.maximum(low[:, None] - bhigh[None], blow[None] - high[:, None]))
    left, right = [], []
    for i, j in zip(*np.nonzero((gap * gap).sum(axis=2) <= budget)):
        x, y = at[i * TILE:(i + 1) * TILE], bt[j * TILE:(j + 1) * TILE]
        a, b = home[x], other[y]
        squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2.0 * (a @ b.T)
        p, q = np.nonzero(squares <= budget)
        left.append(x[p])
        right.append(y[q])
    none = np.empty(0, np.int64)
    return (np.concatenate(left) if left else none), (np.concatenate(right) if right else none)


def _range_join(n_coords: int, budget: float):
    """Rows in order of (cell, part, side): those at home in a cell are held, the others pass by in batches."""
    def run(batches):
        import pyarrow as pa
        here, keys, points, tree = None, [], [], None
        for batch in slices(batches, 4096):
            cells = np.array(batch.column("place").to_pylist(), object)
            cuts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            side = batch.column("side").to_numpy()
            names = np.array(batch.column("key").to_pylist(), object)
            coords = np.stack([batch.column(f"x{j}").to_numpy() for j in range(n_coords)], axis=1)
            for start, end in zip(cuts, [*cuts[1:], len(cells)]):
                if cells[start] != here:
                    here, keys, points, tree = cells[start], [], [], None
                first = start + int(np.searchsorted(side[start:end], 1))
                if first > start:
                    keys.append(names[start:first])
                    points.append(coords[start:first])
                if first < end and points:
                    if tree is None:
                        tree = (np.concatenate(keys), np.concatenate(points))
                    p, q = _within(tree[1], coords[first:end], budget)
                    a, b = tree[0][p], names[first:end][q]
                    found = a < b
                    if found.any():
                        yield pa.record_batch({"a": pa.array(a[found], pa.string()), "b": pa.array(b[found], pa.string())})
    return run


def _candidates(found: DataFrame, dims: int, cosine: float, block_dims: int, held: int = HELD) -> DataFrame:
    """Pairs of classes within the budget of a block, by a range join per block.

    A cell's own rows are held in a task, ``held`` at most: a fuller cell is dealt to several parts, and what
    passes by goes to each of them.
    """
    rows, budget = _blocks(found, dims, cosine, block_dims)
    rows = stored(rows, "blocks")
    coords = [c for c in rows.columns if c[0] == "x" and c[1:].isdigit()]
    radius = math.sqrt(budget)
    grid = coords[:2]

    def place(cells: list[Column]) -> Column:
        return F.concat_ws("/", F.col("block").cast("string"), *[c.cast("string") for c in cells], "label").alias("cell")

    def cell(x: Column) -> Column:
        return F.floor(x / (2 * radius)).cast("int")

    home = rows.select(place([cell(F.col(x)) for x in grid]), "key", *coords)
    full = home.groupBy("cell").agg(F.ceil(F.count("*") / held).cast("int").alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    home = lookup(home, full, ["cell"]).withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))
    touched = [F.array_distinct(F.array(cell(F.col(x) - radius), cell(F.col(x) + radius))) for x in grid]
    passing = rows
    for i, cells in enumerate(touched):
        passing = passing.withColumn(f"c{i}", F.explode(cells))
    passing = passing.select(place([F.col(f"c{i}") for i in range(len(grid))]), "key", *coords)
    passing = lookup(passing, full, ["cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    both = home.withColumn("side", F.lit(0)).unionByName(passing.withColumn("side", F.lit(1))).select(
        F.concat_ws("/", F.col("part").cast("string"), "cell").alias("place"), "side", "key", *coords)
    dealt = both.repartition("place").sortWithinPartitions("place", "side")
    return dealt.mapInArrow(_range_join(len(coords), budget), "a string, b string").distinct()


def _verified(pairs: DataFrame, found: DataFrame, cosine: float) -> DataFrame:
    left = found.select(F.col("key").alias("a"), F.col("vector").alias("va"))
    right = found.select(F.col("key").alias("b"), F.col("vector").alias("vb"))
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    return (pairs.join(left, "a").join(right, "b")
            .filter(dot / (F.sqrt(_squares("va")) * F.sqrt(_squares("vb"))) >= cosine).select("a", "b"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block_dims: int = BLOCK_DIMS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Vectors of one label (not null) and one length are linked when their cosine is ``cosine`` or more.
    Null, empty and zero vectors and those with null, NaN or infinite components have no links. Equal
    vectors of a label form one class: its copies count as links of each other and of every neighbour,
    but are never paired off. Each row counts as a vector, also where ids repeat; a row without id
    has links but no component. An empty table gives no rows; extra columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    found = stored(classes(rows), "classes")
    lengths = sorted(r[0] for r in found.select(F.size("vector")).distinct().collect())  # a few per model
    pairs = None
    for dims in lengths:
        same = found.filter(F.size("vector") == dims)
        part = _verified(stored(_candidates(same, dims, cosine, block_dims), "candidates"), same, cosine)
        pairs = part if pairs is None else pairs.unionByName(part)
    if pairs is None:
        pairs = found.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0)
    pairs = stored(pairs, "pairs")
    both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))
    weights = found.select(F.col("key").alias("b"), F.col("copies").alias("n"))
    others = both.join(weights, "b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    roots = components(pairs, "a", "b").withColumnRenamed("node", "key")
    per_class = (found.select("key", "copies").join(others, "key", "left").join(roots, "key", "left")
                 .select("key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
                         F.coalesce("root", "key").alias("root")))
    usable = F.col("label").isNotNull() & _usable(F.col("embedding").cast("array<double>"))
    keyed = stored(rows.select("vec_id", F.when(usable, _key()).alias("key")).join(per_class, "key", "left"), "keyed")
    least = keyed.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("vec_id").alias("least"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id"))
    return (keyed.join(least, "root", "left").withColumn("component_id", component)
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
                    (F.col("vec_id") == F.col("component_id")).alias("kept")))
