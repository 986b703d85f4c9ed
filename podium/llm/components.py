"""Connected components over a table of links, by alternating star contraction.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): a large-star round ties
the larger neighbours of every node to its smallest one, a small-star round does the same for the
smaller neighbours. A few rounds flatten chains of any length. Links never leave the cluster, and a
node with very many links is only ever an aggregate with partial sums and one side of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).withColumn("m", F.least("u", "m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    return down.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))


def _flat(edges: DataFrame) -> bool:
    """Whether every node points to one other only, and that one to none."""
    ends = (edges.select(F.col("u").alias("n"), F.lit(1).alias("points"), F.lit(0).alias("held"))
            .unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("points"), F.lit(1).alias("held"))))
    nodes = ends.groupBy("n").agg(F.sum("points").alias("points"), F.max("held").alias("held"))
    return not nodes.agg(F.max((F.col("points") > 1) | ((F.col("points") == 1) & (F.col("held") == 1)))).first()[0]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every node that has a link.

    Links may repeat and point either way; nulls and links of a node with itself tie nothing.
    """
    told = F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))
    edges = stored(links.filter(told).select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                   .distinct(), "links")
    while not _flat(edges):
        star = _small_star(_large_star(edges)).filter(F.col("u") != F.col("v")).distinct()
        edges = stored(star, "star")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
