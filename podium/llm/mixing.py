"""Mixing sources to target weights by capped water-filling.

Sources share the total of all sizes by weight, none above a number of epochs of itself; what a capped
source leaves is shared out by weight among the others until none is above. Taking sources in order of
cap over weight, this has a closed form: a source is capped when its cap is no more than its weight's
share of what the ones before it left.

A target is met with whole repetitions of every document and one more of some: documents stand in the
order of a seeded digest of their ids, and the first of them, up to the missing words, are taken once
more. The cut is found in two steps, over bins of the digest and within the bin where it falls, so no
source is ever sorted as a whole. Applying it needs nothing but a row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import WORD, stored

EPOCHS = 3
SEED = "mix-1"


def _order(seed: str) -> Column:
    """Place of a row in its source: by its id, without one by its text."""
    by_text = F.concat(F.lit("text:"), F.xxhash64("text").cast("string"))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), by_text)).cast("binary"))


def _source_key() -> Column:
    """A join key that tells a null source from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``source_key``, ``size`` in words (null: 0) and the digest ``place``."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", _source_key().alias("source_key"), size.alias("size"), _order(seed).alias("place"))


def targets(rows: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Per source: ``source_size``, ``weight`` (1, 2, 3 repeating in code point order, null last) and ``target``.

    One row per source meets in one task, as sources are a short list.
    """
    per = rows.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    whole = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
           .withColumn("cap", F.col("source_size") * epochs)
           .withColumn("total", F.sum("source_size").over(whole))
           .withColumn("ratio", F.col("cap") / F.col("weight")))
    filling = Window.partitionBy().orderBy("ratio", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("capped", F.col("cap") * F.sum("weight").over(onward) <= F.col("weight") * left)
    spare = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight").cast("double") * spare.cast("double") / open_weight.cast("double"))
    return per.withColumn("target", target).select("source_key", "source_size", "weight", "target")


def plan(rows: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Per source: target, ``whole`` repetitions and the last ``place`` that gets one more (null: none).

    ``rows`` are those of :func:`sizes`, stored. Documents with one id, or without id and with one text, share a place and are
    taken together. The cut lies where the words taken come closest to the target.
    """
    goal = targets(rows, epochs)
    goal = (goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
            .withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")))
    goal = stored(goal, "targets")
    binned = rows.withColumn("bin", F.substring("place", 1, 3))
    up_to = Window.partitionBy("source_key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (binned.groupBy("source_key", "bin").agg(F.sum("size").alias("words"))
            .withColumn("start", F.coalesce(F.sum("words").over(up_to), F.lit(0)))
            .join(goal.select("source_key", "missing"), "source_key"))
    # In a bin that ends before the cut all are taken, in one that starts past it none.
    edge = bins.filter((F.col("start") <= F.col("missing")) & (F.col("start") + F.col("words") >= F.col("missing")))
    # A bin a source at most: written, it is known to be the small side, and the documents stay where they are dealt.
    edge = stored(edge.select("source_key", "bin", "start", "missing"), "edge")
    inside = (binned.join(edge, ["source_key", "bin"])
              .groupBy("source_key", "bin", "place", "start", "missing").agg(F.sum("size").alias("words")))
    running = Window.partitionBy("source_key", "bin").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    taken = (F.col("start") + F.sum("words").over(running)) * 2 - F.col("words") <= F.col("missing") * 2
    last = (inside.withColumn("taken", taken).filter("taken").groupBy("source_key").agg(F.max("place").alias("place_in")))
    before = (bins.filter(F.col("start") + F.col("words") < F.col("missing")).groupBy("source_key")
              .agg(F.concat(F.max("bin"), F.lit("~")).alias("bin_in")))  # "~" sorts after every digest digit
    return (goal.join(last, "source_key", "left").join(before, "source_key", "left")
            .select("source_key", "source_size", "target", "whole", F.greatest("place_in", "bin_in").alias("last_place")))


def _copies(epochs: int) -> Column:
    once_more = F.coalesce((F.col("place") <= F.col("last_place")) & (F.col("whole") < epochs), F.lit(False))
    return (F.col("whole") + once_more.cast("long")).cast("long")


def mix(docs: DataFrame, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """What the mix takes of every row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``
    (words, repeats counted), ``copies`` and ``source``.

    A null or blank text has size 0 and adds nothing; a null source is a source of its own; an empty
    table gives no rows. The same rows, seed and epochs give the same mix on every run.
    """
    rows = stored(sizes(docs, seed), "sizes")
    chosen = rows.join(plan(rows, epochs), "source_key").withColumn("copies", _copies(epochs))
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                         "copies", "source")


def mixed_documents(docs: DataFrame, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as the mix takes it.

    Needs ``doc_id``, ``text`` and ``source``; further columns, whatever their names, pass unread. A null or blank
    text has no words: it adds nothing to the target and comes as often as its place says, never in a source that has no words at all.
    Nulls, repeated rows and ties are as in :func:`mix`; an empty table gives no rows. Only a row per source is joined, the documents are not shuffled.
    """
    per_source = plan(stored(sizes(docs, seed), "sizes"), epochs)
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole_row.alias("row"), _source_key().alias("source_key"), _order(seed).alias("place"))
    return (rows.join(per_source.select("source_key", "whole", "last_place"), "source_key")
            .withColumn("copies", _copies(epochs)).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
