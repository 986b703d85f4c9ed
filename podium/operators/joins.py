"""Join operators. None of them carries a broadcast hint, see ``podium.session``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.operators.windows import top1

MANY = 100_000  # rows up to which Spark's own estimate of a side is trusted


def sized(side: DataFrame, rows: int | None = None) -> DataFrame:
    """``side``, to be joined by shuffle if it has many ``rows`` (counted here unless they are given).

    Spark takes the size of the files a side is read from for the size of its rows. Compressed keys are a tenth of that and
    less, and a broadcast planned by it is not taken back when the rows turn out to be too many for the driver.
    """
    return side.hint("merge") if (side.count() if rows is None else rows) > MANY else side


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a ``table`` that holds one row per key, however unevenly ``rows`` use them.

    The table was made unique by a grouping on the same keys, and Spark would join in that
    partitioning. AQE only splits the partition a busy key has filled when both sides are shuffled
    for the join, so a column derived from the keys is joined on as well: the grouping no longer
    fits, and the (small) table is shuffled once more. A table under the broadcast limit is
    broadcast all the same.
    """
    spread = F.xxhash64(*keys)
    return (rows.withColumn("_spread", spread)
            .join(table.withColumn("_spread", spread), [*keys, "_spread"], "left").drop("_spread"))


def resolve_alias(df: DataFrame, col: str, aliases: DataFrame) -> DataFrame:
    """Replace ``col`` by its canonical id, or by its own lower-cased text when unmapped.

    Case and padding are ignored on both sides. A doubly declared alias resolves to its smallest
    id, so a row is never duplicated.
    """
    known = (aliases
             .select(F.lower(F.trim("alias")).alias("_alias"), F.col("canonical_player_id").alias("_canonical"))
             .filter(F.col("_alias").isNotNull())
             .groupBy("_alias").agg(F.min("_canonical").alias("_canonical")))
    plain = F.lower(F.trim(F.col(col)))
    return (lookup(df.withColumn("_alias", plain), known, ["_alias"])
            .withColumn(col, F.coalesce("_canonical", "_alias"))
            .drop("_alias", "_canonical"))


def lookup_sk(facts: DataFrame, dim: DataFrame, fact_key: str = "player_id",
              dim_key: str = "player_id", sk: str = "player_sk") -> DataFrame:
    """Surrogate key of the current version, null when there is none.

    The newest current version wins, so a fact never fans out.
    """
    players = dim.filter(F.col("is_current")).filter(F.col(dim_key).isNotNull())
    players = top1(players, [dim_key], [F.col("valid_from").desc_nulls_last(), F.col(sk).asc()])
    players = players.select(F.col(dim_key).alias(fact_key), sk)
    return lookup(facts, players, [fact_key])


def full_outer_coalesce(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "full")


def new_only(df: DataFrame, existing: DataFrame, keys: Sequence[str], busy_keys: bool = False) -> DataFrame:
    """Rows whose key is not in ``existing`` yet. Reads nothing but the keys of ``existing``.

    ``busy_keys`` tells that one key may fill many rows of ``df``. The join then keeps to a
    partitioning of its own, as in :func:`lookup`, so that AQE may split it whatever follows.
    """
    known = existing.select(*keys)
    if not busy_keys:
        return df.join(known, list(keys), "left_anti")
    spread = F.xxhash64(*keys)
    return (df.withColumn("_spread", spread)
            .join(known.withColumn("_spread", spread), [*keys, "_spread"], "left_anti").drop("_spread"))


def not_reviewed(df: DataFrame, reviewed: DataFrame, key: str = "session_id") -> DataFrame:
    """Exclusion list that, unlike ``NOT IN``, survives a null in the list."""
    return new_only(df, reviewed, [key])


def forward_window_join(left: DataFrame, right: DataFrame, key: str, left_day: str,
                        right_day: str, days: int) -> DataFrame:
    """Left outer join on ``key`` and ``right_day`` within ``[left_day, left_day + days]``.

    Days fall into slots of ``days + 1``. The window of a left row that ends in its own slot or
    the next can only be met by right rows sent to those two, so the join is an equi-join on
    (key, slot) and one busy key is spread over time. With rows of day grain on both sides the
    output holds at most ``days + 1`` rows per left row.
    """
    def slot(day):
        return F.floor(F.unix_date(day) / (days + 1))

    placed = left.withColumn("_slot", slot(F.col(left_day)))
    offered = (right
               .withColumn("_slot", F.explode(F.sequence(
                   slot(F.date_sub(right_day, days)), slot(F.col(right_day)))))
               .withColumnsRenamed({key: "_key", "_slot": "_offered"}))
    return (placed.join(
        offered,
        (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_offered"))
        & F.col(right_day).between(F.col(left_day), F.date_add(F.col(left_day), days)),
        "left")
        .drop("_slot", "_offered", "_key"))


def nearest_following(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                      days: int, tie_break: Sequence, distance: str) -> DataFrame:
    """Closest right row on or after ``left_day`` within ``days``; one row out per left row.

    ``left`` holds one row per key and day. The right side is first cut to one row per key and
    day (``tie_break`` decides), so the single pass over a key is bounded by the calendar however
    many rows the key has, and no pair of rows is ever formed.
    """
    usable = F.col(right_day).isNotNull() & F.col(key).isNotNull()  # a null key matches nothing
    first_of_day = top1(right.filter(usable), [key, right_day], tie_break)
    payload = [c for c in right.columns if c != key]
    wanting = left.select(
        F.col(key).alias("_key"), F.col(left_day).alias("_day"), F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"))
    offering = first_of_day.select(
        F.col(key).alias("_key"), F.col(right_day).alias("_day"), F.lit(0).alias("_side"),
        F.struct(*payload).alias("_right"))
    backwards = (Window.partitionBy("_key").orderBy(F.col("_day").desc(), "_side")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = (wanting.unionByName(offering, allowMissingColumns=True)
            .withColumn("_near", F.last("_right", ignorenulls=True).over(backwards))
            .filter(F.col("_side") == 1))
    gap = F.date_diff(F.col(f"_near.{right_day}"), F.col("_day"))
    linked = seen.withColumn(distance, F.when(gap <= days, gap))
    reached = F.col(distance).isNotNull()
    return linked.select(
        "_left.*",
        *[F.when(reached, F.col(f"_near.{c}")).alias(c) for c in payload],
        distance)


def version_at(facts: DataFrame, dim: DataFrame, key: str, day: str, sk: str = "player_sk",
               valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Surrogate key of the version in force at the start of ``day``, null when there is none.

    A key's versions travel as one ordered list, at most one a calendar day, and the facts pass once: each
    takes its key's list by a lookup, which AQE splits for busy keys, and the last version that has begun.
    """
    starts = F.to_date(valid_from)
    effective = F.when(F.col(valid_from) == starts.cast("timestamp"), starts).otherwise(F.date_add(starts, 1))
    versions = top1(
        dim.select(F.col(key).alias("_key"), effective.alias("_day"), valid_from,
                   F.struct(F.col(sk).alias("sk"), F.col(valid_to).alias("ends")).alias("_version")),
        ["_key", "_day"], [F.col(valid_from).desc(), F.col("_version.sk").asc()]).drop(valid_from)
    history = versions.groupBy(F.col("_key").alias(key)).agg(
        F.sort_array(F.collect_list(F.struct("_day", "_version"))).alias("_history"))

    def begun(version: Column) -> Column:
        since_ever = version["_day"].isNull() & F.col(day).isNotNull()
        return since_ever | (version["_day"] <= F.col(day))

    at = lookup(facts, history, [key]).withColumn("_at", F.try_element_at(F.filter("_history", begun), F.lit(-1))["_version"])
    open_ended = F.col("_at.ends").isNull() | (F.col("_at.ends") > F.col(day).cast("timestamp"))
    return at.withColumn(sk, F.when(open_ended, F.col("_at.sk"))).drop("_history", "_at")
