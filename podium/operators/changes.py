"""Operators that derive the next state of a table from the current one and a change set.

They return the new state; ``podium.sources.sinks`` writes it without overwriting its own input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.scalars import surrogate_key, typed_null
from podium.operators.conform import conform
from podium.operators.joins import new_only
from podium.operators.windows import dedupe
from podium.schemas import EVAL_SET


def unseen(df: DataFrame, existing: DataFrame | None, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Rows to insert: one per key, and only keys the target does not hold.

    A row that lacks part of its key cannot be known again and is no row to insert, see :func:`keyless`.
    """
    fresh = dedupe(df.dropna(subset=list(keys)), keys, order)
    return fresh if existing is None else new_only(fresh, existing, keys)


def keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that lack part of their key, with an id made of what they hold besides lineage."""
    content = [c for c in df.columns if not c.startswith("_")]
    return (df.filter(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
            .withColumn("reject_id", F.sha2(F.to_json(F.struct(*content)), 256)))


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed keys replaced, new keys added, every other row kept."""
    return new_only(target, changes, keys).unionByName(changes)


def replace_slice(target: DataFrame, fresh: DataFrame, keep: Column) -> DataFrame:
    """Rows of ``target`` for which ``keep`` holds, plus ``fresh``; absent columns become null."""
    return target.filter(keep).unionByName(fresh, allowMissingColumns=True)


def newer_than(df: DataFrame, col: str, target: DataFrame | None, target_col: str,
               look_back: Column | None = None) -> DataFrame:
    """Rows above the highest key of ``target``; an absent or empty target lets all rows through.

    ``look_back`` maps the high-water mark (column ``_high``) to an earlier one, so that late rows
    are picked up again.
    """
    if target is None:
        return df
    mark = target.agg(F.max(target_col).alias("_high"))
    floor = F.col("_high") if look_back is None else look_back
    mark = mark.select(floor.alias("_floor"))
    above = F.col(col) > mark.scalar()
    return df.filter(mark.scalar().isNull() | above)


def set_status(findings: DataFrame, decisions: DataFrame, key: str = "finding_id",
               status: str = "coach_status") -> DataFrame:
    """Apply the last decision taken on each finding."""
    last = dedupe(decisions, [key], [F.col("decided_at").desc(), F.col(status).asc()])
    last = last.select(key, F.col(status).alias("_decided"))
    return (findings.join(last, key, "left")
            .withColumn(status, F.coalesce("_decided", status)).drop("_decided"))


def approve(eval_set: DataFrame, approvals: DataFrame, now: Column | None = None) -> DataFrame:
    """Evaluation set with a batch of approvals added; blank optional answers become null."""
    typed = conform(approvals, EVAL_SET).withColumns({
        "issue": F.nullif("issue", F.lit("")),
        "recommendation": F.nullif("recommendation", F.lit("")),
        "approved_at": F.coalesce("approved_at", F.current_timestamp() if now is None else now),
    })
    return eval_set.unionByName(typed)


def scd2_history(snapshots: DataFrame, key: str, tracked: Sequence[str], valid_from: str,
                 order: Sequence) -> DataFrame:
    """Validity intervals from dated snapshots: unchanged snapshots merge into one version.

    The last snapshot of a key and day stands for the day, which bounds the ordered pass.
    """
    daily = dedupe(snapshots, [key, valid_from], order)
    timeline = Window.partitionBy(key).orderBy(valid_from)
    state = F.struct(*tracked)
    changed = (daily
               .withColumn("_before", F.lag(state).over(timeline))
               .filter(F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before")))
               .drop("_before"))
    return (changed
            .withColumn("valid_to", F.lead(valid_from).over(timeline))
            .withColumn("is_current", F.col("valid_to").isNull())
            .withColumn("player_sk", surrogate_key(key, valid_from)))


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str],
               as_of: Column, order: Sequence) -> DataFrame:
    """Close the current version of every changed key and open a new one.

    Unchanged keys, keys missing from ``incoming`` and closed versions stay as they are. One
    shuffle brings each key's current version and its incoming row together.
    """
    attributes = [c for c in dim.columns if c not in (key, "player_sk", "valid_from", "valid_to", "is_current")]
    fresh = dedupe(incoming, [key], order).select(key, F.struct(*attributes).alias("_new"))
    is_current = F.coalesce(F.col("is_current"), F.lit(False))  # a version of unknown state stays as it is
    current = dim.filter(is_current).select(
        key, F.struct(*attributes).alias("_old"), "player_sk", "valid_from")
    both = current.join(fresh, key, "full")

    def differs() -> Column:
        old, new = (F.struct(*[F.col(f"{side}.{c}") for c in tracked]) for side in ("_old", "_new"))
        return ~old.eqNullSafe(new)

    action = (F.when(F.col("_new").isNull(), "keep")
              .when(F.col("_old").isNull(), "open")
              .when(differs(), "replace").otherwise("keep"))
    version = "struct<attrs:{0},player_sk:string,valid_from:timestamp,valid_to:timestamp,is_current:boolean>"
    version = version.format(dict(fresh.dtypes)["_new"])

    def row(attrs: str, sk: Column, start: Column, end: Column, is_current: bool) -> Column:
        return F.struct(F.col(attrs), sk, start, end, F.lit(is_current)).cast(version)

    kept = row("_old", F.col("player_sk"), F.col("valid_from"), typed_null("timestamp"), True)
    closed = row("_old", F.col("player_sk"), F.col("valid_from"), as_of, False)
    opened = row("_new", surrogate_key(key, as_of), as_of, typed_null("timestamp"), True)
    rows = (both.withColumn("_action", action)
            .select(key, F.explode(
                F.when(F.col("_action") == "keep", F.array(kept))
                .when(F.col("_action") == "open", F.array(opened))
                .otherwise(F.array(closed, opened))).alias("_row"))
            .select(key, "_row.attrs.*", "_row.player_sk", "_row.valid_from", "_row.valid_to", "_row.is_current"))
    return rows.select(dim.columns).unionByName(dim.filter(~is_current))
