"""Typing, lineage and padding of incoming rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.predicates import require
from podium.functions.scalars import deterministic_id, typed_null


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One projection onto ``schema``: safe casts, absent columns as typed nulls."""
    present = {f.name: f.dataType for f in df.schema}
    return df.selectExpr(*[_as_type(f, present.get(f.name)) for f in schema])


def _as_type(field: T.StructField, found: T.DataType | None) -> str:
    kind = field.dataType.simpleString()
    if found is None:
        return f"CAST(NULL AS {kind}) AS `{field.name}`"
    if found == field.dataType:
        return f"`{field.name}`"
    return f"try_cast(`{field.name}` AS {kind}) AS `{field.name}`"


def with_lineage(df: DataFrame, source: str | Column, version: str, hash_cols: list[str],
                 ingested_at: Column | None = None) -> DataFrame:
    """Add source, ingest time, version and a hash of the row's key.

    A row that already states when it was ingested keeps that time.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    stated = [F.col("_ingested_at")] if "_ingested_at" in df.columns else []
    return df.withColumns({
        "_source_file": F.lit(source) if isinstance(source, str) else source,
        "_ingested_at": F.coalesce(*stated, now),
        "_pipeline_version": F.lit(version),
        "_record_hash": F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in hash_cols]), 256),
    })


def enrich_intake(df: DataFrame, version: str, now: Column | None = None) -> DataFrame:
    """Identity and validity columns of a new intake row."""
    now = F.current_timestamp() if now is None else now
    return df.withColumns({
        "student_id": deterministic_id("intake_id"),
        "_ingested_at": now,
        "_pipeline_version": F.lit(version),
        "is_active": F.lit(True),
        "valid_from": now,
        "valid_to": typed_null("timestamp"),
        "is_current": F.lit(True),
    })


def map_fields(df: DataFrame, answers: str, fields: Mapping[str, str],
               required: tuple[str, ...] = ()) -> DataFrame:
    """Form answers held in a map column, as one column per mapped question.

    Rows that leave a required question unanswered are dropped.
    """
    others = [c for c in df.columns if c != answers]
    mapped = df.select(*others, *[F.col(answers)[key].alias(name) for key, name in fields.items()])
    return require(mapped, required) if required else mapped
