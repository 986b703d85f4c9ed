"""Text expressions: file names, fenced payloads, extraction payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.scalars import _col

# File names are stamp_player_type_page.png, the stamp being yyyyMMddHHmm.
FILE_SUFFIX = ".png"
STAMP_DIGITS, DATE_DIGITS = 12, 8
SESSION_TYPES = ("match", "training")
_DIGITS = "0123456789"


def parse_session_files(df: DataFrame, path: str = "path") -> DataFrame:
    """Session metadata read off the file name; works on a batch and on a stream.

    The name is split once. A part that is missing or of another form becomes empty text, an
    impossible date or page becomes null. A type may go on (``match2``), but not before a page.
    """
    last = F.substring_index(_col(path), "/", -1)
    stem = F.substr(last, F.lit(1), F.length(last) - len(FILE_SUFFIX))
    name = F.when(F.endswith(last, F.lit(FILE_SUFFIX)), stem).otherwise("")
    # Each step is one element that is taken out of an array again: projections above do not write its
    # expressions out a second time, which would make the generated code too large to compile.
    named = df.withColumn("filename", F.explode(F.array(name)))
    cut = named.withColumn("_cut", F.explode(F.array(F.struct(
        F.split("filename", "_").alias("parts"),
        (F.length("filename") - F.length(F.ltrim("filename", F.lit(_DIGITS)))).alias("digits")))))

    parts, digits = F.col("_cut.parts"), F.col("_cut.digits")

    def or_empty(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise("")

    def slice_of(start: int, end: int) -> Column:
        return or_empty(digits >= end, F.substring("filename", start + 1, end - start))

    stamped = (digits == STAMP_DIGITS) & (F.length(parts[0]) == STAMP_DIGITS)
    cut = cut.withColumn("_player", F.explode(F.array(F.coalesce(or_empty(stamped, F.get(parts, F.lit(1))), F.lit("")))))
    player, said, page = F.col("_player"), F.get(parts, F.lit(2)), F.element_at(parts, -1)
    kinds = [F.when((player != "") & F.startswith(said, F.lit(kind)), kind) for kind in SESSION_TYPES]
    paged = ((F.size(parts) > 2) & F.get(parts, F.size(parts) - 2).isin(*SESSION_TYPES)
             & (F.ltrim(page, F.lit(_DIGITS)) == ""))
    cut = cut.withColumn("session_type", F.explode(F.array(F.coalesce(*kinds, F.lit("")))))
    return cut.withColumns({
        "session_date": F.try_to_date(slice_of(0, DATE_DIGITS), "yyyyMMdd"),
        "session_time": slice_of(DATE_DIGITS, STAMP_DIGITS),
        "player_name": or_empty(F.size(parts) > 2, player),
        "page_number": F.when(paged, page).try_cast("int"),
        "session_id": F.concat_ws("_", slice_of(0, STAMP_DIGITS), player, "session_type"),
    }).drop("_cut", "_player")


def valid_session_file(df: DataFrame) -> DataFrame:
    """Files whose name gave all four: a day, a player, a type and a page."""
    return df.dropna(subset=["session_date", "page_number"]).filter(F.least(F.length("player_name"), F.length("session_type")) > 0)


def strip_scheme(path: str | Column, scheme: str = "dbfs:") -> Column:
    return F.replace(_col(path), F.lit(scheme), F.lit(""))


def strip_fences(text: str | Column) -> Column:
    """Drop Markdown fence lines when the text starts with one; trims the result."""
    blanks = F.lit(" \t\r\n")
    body = F.btrim(_col(text), blanks)
    kept = F.filter(F.split(body, "\n"), lambda line: ~F.startswith(F.btrim(line, blanks), F.lit("```")))
    return F.when(F.startswith(body, F.lit("```")), F.btrim(F.array_join(kept, "\n"), blanks)).otherwise(body)


def encode_content(content: str | Column) -> Column:
    """Binary page content as base64 text on one line."""
    return F.translate(F.base64(_col(content)), "\r\n", "")
