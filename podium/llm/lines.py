"""Line de-duplication by pairwise alignment.

Documents are compared as sequences of line hashes. A run is the shortest series of lines, from a line on
or up to a line, that has ``block_chars`` characters; every common block is covered by the runs within it.
A run or line that occurs in several documents points from each later one to the first that holds it, so
what n documents share makes n - 1 pairs and never all of them. A pair is aligned if it shares a run, a rare
line, or enough text in single lines to fill a block.
The alignment is patience diff: lines unique in both stretches, in their longest common order, are
anchors; between anchors it recurses, and equal lines next to an anchor join it. Runs of aligned lines
with at least ``block_chars`` characters are common blocks; between them the heaviest further ones are sought
without anchors. They are deleted from the later document, with all their repetitions there.

The first holder of a line is never deleted for that line, so one copy of everything stays.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import mixed, slices, stored

BLOCK_CHARS = 160
RARE = 8
RARE_CHARS = 40
_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse among 64-bit numbers


def _ordered_anchors(a: Sequence[int], b: Sequence[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines that occur once in either stretch, as the longest series that rises in both."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    place = {line: j for j, line in enumerate(b[b0:b1], b0) if in_b[line] == 1 and in_a.get(line) == 1}
    tops: list[int] = []
    piles: list[int] = []
    found: list[tuple[int, int, int]] = []  # line of a, line of b, predecessor
    for i in range(a0, a1):
        j = place.get(a[i])
        if j is None:
            continue
        pile = bisect_left(tops, j)
        found.append((i, j, piles[pile - 1] if pile else -1))
        if pile == len(tops):
            tops.append(j)
            piles.append(len(found) - 1)
        else:
            tops[pile], piles[pile] = j, len(found) - 1
    chain, at = [], piles[-1] if piles else -1
    while at >= 0:
        i, j, at = found[at]
        chain.append((i, j))
    return chain[::-1]


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Patience alignment of two sequences: pairs of equal places, rising in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = _ordered_anchors(a, b, a0, a1, b0, b1)
        for i, j in anchors:
            pairs.append((i, j))
            todo.append((a0, i, b0, j))
            a0, b0 = i + 1, j + 1
        if anchors:
            todo.append((a0, a1, b0, b1))
    return sorted(pairs)


def _blocks_between(later: Sequence[int], earlier: Sequence[int], chars: Sequence[int], total: np.ndarray,
                    known: list[tuple[int, int, int]], block_chars: int) -> list[tuple[int, int, int]]:
    """``known`` blocks (line of later, line of earlier, lines), rising in both, and the heaviest ones that fit between."""
    start, end, whole = runs(later, chars, block_chars)
    sizes = dict(zip(later, chars))
    start_e, end_e, whole_e = runs(earlier, [sizes.get(line, 0) for line in earlier], block_chars)
    both = np.isin(whole, whole_e)
    start, end, whole = start[both], end[both], whole[both]
    also = np.isin(whole_e, whole)
    start_e, end_e, whole_e = start_e[also], end_e[also], whole_e[also]
    found, todo = list(known), []
    a0 = b0 = 0
    for i, j, n in [*known, (len(later), len(earlier), 0)]:
        todo.append((a0, i, b0, j))
        a0, b0 = i + n, j + n
    while todo:
        a0, a1, b0, b1 = todo.pop()
        inside = np.flatnonzero((start >= a0) & (end <= a1))
        inside_e = np.flatnonzero((start_e >= b0) & (end_e <= b1))
        if not len(inside) or not len(inside_e):
            continue
        place = dict(zip(whole_e[inside_e][::-1].tolist(), start_e[inside_e][::-1].tolist()))
        best, reached = None, {}
        for i, h in sorted(zip(start[inside].tolist(), whole[inside].tolist())):
            j = place.get(h)
            if j is None or i < reached.get(i - j, 0):
                continue
            x, y, n = i, j, 0
            while x > a0 and y > b0 and later[x - 1] == earlier[y - 1]:
                x, y = x - 1, y - 1
            while x + n < a1 and y + n < b1 and later[x + n] == earlier[y + n]:
                n += 1
            reached[i - j] = x + n
            weight = int(total[x + n] - total[x])
            if weight >= block_chars and (best is None or weight > best[0]):
                best = (weight, x, y, n)
        if best:
            _, x, y, n = best
            found.append((x, y, n))
            todo += [(a0, x, b0, y), (x + n, a1, y + n, b1)]
    return sorted(found)


def common_lines(later: Sequence[int], earlier: Sequence[int], chars: Sequence[int], block_chars: int) -> list[int]:
    """Lines of ``later`` that lie in an aligned run of ``block_chars`` or more characters, or in its repetitions.

    Where the alignment has no block, as it finds no unique line or follows short ones, the heaviest common
    block of the stretch is taken, and again on either side of it. Blocks rise in both documents: of two
    that changed places one is taken. What is taken is then found in ``later`` wherever it stands.
    """
    total = np.concatenate([[0], np.cumsum(np.asarray(chars, np.int64))])
    aligned: list[tuple[int, int, int]] = []
    for i, j in align(later, earlier):
        if aligned and (i, j) == (aligned[-1][0] + aligned[-1][2], aligned[-1][1] + aligned[-1][2]):
            aligned[-1] = (*aligned[-1][:2], aligned[-1][2] + 1)
        else:
            aligned.append((i, j, 1))
    blocks = [(i, j, n) for i, j, n in aligned if total[i + n] - total[i] >= block_chars]
    blocks = _blocks_between(later, earlier, chars, total, blocks, block_chars)
    removed = np.zeros(len(later), bool)
    for i, _, n in blocks:
        removed[i:i + n] = True
    if blocks and not removed.all():
        start, end, whole = runs(later, chars, block_chars)
        inside = np.zeros(len(whole), bool)
        for i, _, n in blocks:
            inside |= (start >= i) & (end <= i + n)
        for at in np.flatnonzero(np.isin(whole, whole[inside]) & ~inside):
            removed[start[at]:end[at]] = True
    return np.flatnonzero(removed).tolist()


def _powers(factor: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, factor, np.uint64)]))


def runs(lines: Sequence[int], chars: Sequence[int], block_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, end and hash of the shortest runs of ``block_chars`` characters from and up to each line.

    Every line of a series with that many characters lies in such a run within the series, blank ones at
    its ends aside.
    """
    n = len(lines)
    total = np.concatenate([[0], np.cumsum(np.asarray(chars, np.int64))])
    written = np.flatnonzero(np.diff(total) > 0)
    ends = np.searchsorted(total, total[written] + block_chars)
    begins = np.searchsorted(total, total[written + 1] - block_chars, "right") - 1
    start = np.concatenate([written[ends <= n], begins[begins >= 0]])
    end = np.concatenate([ends[ends <= n], written[begins >= 0] + 1])
    terms = np.asarray(lines, np.int64).view(np.uint64) * _powers(_FACTOR, n)[:n]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    back = _powers(pow(_FACTOR, -1, 1 << 64), n)
    return start, end, mixed((sums[end] - sums[start]) * back[start]).view(np.int64)


def _nodes(docs: DataFrame) -> DataFrame:
    """Distinct (id, text) with the hashes and lengths of their lines, white space at the ends aside."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.trim(line))
    return (docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
            .select(F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("node"),
                    F.transform(lines, lambda line: F.xxhash64(line)).alias("lines"),
                    F.transform(lines, lambda line: F.char_length(line)).alias("chars"))
            .dropDuplicates(["node"]))


def _runs(nodes: DataFrame, block_chars: int) -> DataFrame:
    """``node`` and ``hash`` of the distinct runs of every document."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.unique(runs(a, c, block_chars)[2]) for a, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "runs"])

    found = nodes.select("node", "lines", "chars").mapInArrow(work, "node struct<doc_id:bigint,text_hash:bigint>, runs array<bigint>")
    return found.select("node", F.explode("runs").alias("hash"))


def common_blocks(docs: DataFrame, block_chars: int = BLOCK_CHARS, rare: int = RARE) -> DataFrame:
    """``node`` (id and text hash) and ``removed``, the places of the lines to delete, of later documents."""
    nodes = stored(_nodes(docs), "lines")
    held = (nodes.select("node", F.explode(F.array_distinct(F.arrays_zip("lines", "chars"))).alias("line"))
            .select("node", F.col("line.lines").alias("hash"), F.col("line.chars").alias("chars")).filter("chars > 0"))
    shared = (held.groupBy("hash").agg(F.min("node").alias("first"), F.count("*").alias("holders")).filter("holders > 1"))
    is_rare = (F.col("holders") <= rare) & (F.col("chars") >= RARE_CHARS)
    pairs = (held.join(shared, "hash").filter("node != first").groupBy("node", "first")
             .agg(F.sum("chars").alias("support"), F.max(is_rare).alias("rare"))
             .filter(F.col("rare") | (F.col("support") >= block_chars)).select("node", "first"))
    whole = _runs(nodes, block_chars)
    several = whole.groupBy("hash").agg(F.min("node").alias("first"), F.count("*").alias("holders")).filter("holders > 1")
    pairs = pairs.unionByName(whole.join(several, "hash").filter("node != first").select("node", "first")).distinct()
    sides = (pairs.join(nodes, "node")
             .join(nodes.select(F.col("node").alias("first"), F.col("lines").alias("earlier")), "first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            later, earlier, chars = (batch.column(i).to_pylist() for i in (1, 2, 3))
            removed = [common_lines(a, b, c, block_chars) for a, b, c in zip(later, earlier, chars)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.list_(pa.int32()))], ["node", "removed"])

    found = sides.select("node", "lines", "earlier", "chars").mapInArrow(
        work, "node struct<doc_id:bigint,text_hash:bigint>, removed array<int>")
    return (found.filter(F.size("removed") > 0).select("node", F.explode("removed").alias("line"))
            .groupBy("node").agg(F.sort_array(F.collect_set("line")).alias("removed")))


def line_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS, rare: int = RARE) -> DataFrame:
    """``doc_id``, ``text`` without the common blocks, ``n_lines``, ``n_removed`` and ``removed`` of every row.

    Later means a larger ``doc_id`` (then a larger hash of the text). Rows with a null id or text come
    back as they are; rows equal in both are one document and are treated alike; a text whose lines are
    all deleted becomes empty. Blank lines anchor nothing by themselves but belong to the blocks around
    them. An empty table gives no rows; extra columns are not read.
    """
    removed = common_blocks(docs, block_chars, rare).select(
        F.col("node.doc_id").alias("__id"), F.col("node.text_hash").alias("__hash"), "removed")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("__own"))
    joined = rows.join(removed, (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__hash")), "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("removed"), i)), "\n")
    return joined.select(
        "doc_id", F.when(F.col("removed").isNotNull(), kept).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)).alias("n_lines"),
        F.coalesce(F.when(F.col("removed").isNotNull(), F.size("removed")), F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
