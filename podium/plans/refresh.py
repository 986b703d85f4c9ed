"""Change feeds carried from bronze to the marts: what a changed row touches is worked out again, and nothing else.

Every table is stored by month. A change says a row's key and its new state, or that it is gone. The rows it
replaces are found by the key index of the bronze table; old and new rows together name the grains they touch
(player and day, then week, then month). Each model works out its touched grains from the partitions that hold
their input and replaces them: a grain that has no row any more is removed, so a mart after a refresh
equals one built from all rows. The dimension is an input; a new version of a player reaches old facts by
a build.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.scalars import week_start, year_month
from podium.operators.joins import sized
from podium.plans import intermediate, marts, staging
from podium.plans.build import calculated
from podium.session import scratch_dir
from podium.sources.key_index import in_partitions, partitions_of
from podium.sources.readers import table, table_exists
from podium.sources.sinks import apply_changes, materialize, replace_grains

_WEEK_LAST = 6  # days from the first to the last of a week


def refresh(folder: str, aliases: DataFrame, dim: DataFrame, matches: DataFrame | None = None,
            training: DataFrame | None = None, now: Column | None = None) -> dict[str, DataFrame]:
    """Bring the tables below ``folder`` up to the changed bronze rows and return them.

    ``matches`` and ``training`` have the columns of their bronze tables and ``_deleted``, one row per key; of a
    deleted row only the key counts. A table that does not exist starts with the changes. Bronze rows are stored by the month
    of their day; a row without a day stays in the partition of null and touches nothing.
    """
    spark = dim.sparkSession
    aliases, dim, days = sized(aliases), sized(dim), []
    if matches is not None:
        rows = matches.withColumn("match_month", year_month("match_date"))
        before = apply_changes(rows, f"{folder}/raw_matches", ["match_id"], "match_month")
        days.append(_match_facts(folder, before, rows, aliases, dim))
    if training is not None:
        rows = training.withColumn("session_month", year_month("session_date"))
        before = apply_changes(rows, f"{folder}/raw_training", ["session_id"], "session_month")
        days.append(_training_facts(folder, before, rows, aliases, dim))
    touched = days[0] if len(days) == 1 else days[0].unionByName(days[1])
    weeks = sized(materialize(touched.select("player_id", week_start("day").alias("score_week")).distinct()
                              .withColumn("score_month", year_month("score_week")), scratch_dir(spark, "weeks")))
    _scores(folder, weeks, now)
    _digest(folder, weeks, now)
    months = touched.select("player_id", year_month("day").alias("report_month")).unionByName(
        weeks.select("player_id", F.col("score_month").alias("report_month")))
    _report(folder, sized(materialize(months.distinct(), scratch_dir(spark, "months"))), now)
    return {name: table(spark, f"{folder}/{name}") for name in (
        "fct_match", "fct_training", "development_score", "weekly_digest", "monthly_report")
        if table_exists(spark, f"{folder}/{name}")}


def _match_facts(folder: str, before: DataFrame, changed: DataFrame, aliases: DataFrame, dim: DataFrame) -> DataFrame:
    """Matches of the touched players and days; returns those (player_id, day)."""
    spark = dim.sparkSession
    old_and_new = before.unionByName(changed.drop("_deleted"), allowMissingColumns=True)
    touched = _stored_days(staging.stg_match(old_and_new, aliases), "match_date", "match_year_month")
    raw = in_partitions(table(spark, f"{folder}/raw_matches"), "match_month", partitions_of(touched, "match_year_month"))
    staged = staging.stg_match(raw, aliases).join(touched.select("player_id", "match_date"), ["player_id", "match_date"], "left_semi")
    facts = marts.fct_match(intermediate.match_strength(staged), dim)
    replace_grains(facts, touched, f"{folder}/fct_match", ["player_id", "match_date"], "match_year_month")
    return touched.select("player_id", F.col("match_date").alias("day"))


def _training_facts(folder: str, before: DataFrame, changed: DataFrame, aliases: DataFrame, dim: DataFrame) -> DataFrame:
    """Rollups of the touched players and days; returns those (player_id, day)."""
    spark = dim.sparkSession
    old_and_new = before.unionByName(changed.drop("_deleted"), allowMissingColumns=True)
    touched = _stored_days(staging.stg_training(old_and_new, aliases), "session_date", "session_year_month")
    raw = in_partitions(table(spark, f"{folder}/raw_training"), "session_month", partitions_of(touched, "session_year_month"))
    staged = staging.stg_training(raw, aliases).join(
        touched.select("player_id", "session_date"), ["player_id", "session_date"], "left_semi")
    facts = marts.fct_training(intermediate.daily_rollup(staged), dim)
    replace_grains(facts, touched, f"{folder}/fct_training", ["player_id", "session_date"], "session_year_month")
    return touched.select("player_id", F.col("session_date").alias("day"))


def _stored_days(staged: DataFrame, day: str, month: str) -> DataFrame:
    days = staged.select("player_id", day).distinct().withColumn(month, year_month(day))
    return sized(materialize(days, scratch_dir(staged.sparkSession, "days")))


def _scores(folder: str, weeks: DataFrame, now: Column | None) -> None:
    """Scores of the touched weeks, from the facts of the months these lie in."""
    ends = F.explode(F.array("score_week", F.date_add("score_week", _WEEK_LAST)))
    months = partitions_of(weeks.select(ends.alias("day")).select(year_month("day").alias("m")), "m")

    def within(facts: DataFrame, day: str) -> DataFrame:
        return (facts.withColumn("score_week", week_start(day)).join(weeks, ["player_id", "score_week"], "left_semi")
                .drop("score_week"))

    spark = weeks.sparkSession
    played = _cut(spark, f"{folder}/fct_match", "match_year_month", months)
    trained = _cut(spark, f"{folder}/fct_training", "session_year_month", months)
    score = marts.development_score(within(played, "match_date"), within(trained, "session_date"))
    replace_grains(calculated(score.withColumn("score_month", year_month("score_week")), now), weeks,
                   f"{folder}/development_score", ["player_id", "score_week"], "score_month")


def _digest(folder: str, weeks: DataFrame, now: Column | None) -> None:
    """Touched weeks, and the first week after each, whose change is taken from another score now.

    What stands before and after a week is read off the touched players' scores: three columns of one row per week.
    """
    spark = weeks.sparkSession
    scores = table(spark, f"{folder}/development_score").drop("score_month", "calculated_at")
    players = weeks.select("player_id").distinct()
    present = scores.select("player_id", "score_week", F.lit(True).alias("present")).join(players, "player_id", "left_semi")
    marks = weeks.select("player_id", "score_week", F.lit(True).alias("mark"))
    line = present.join(marks, ["player_id", "score_week"], "full")
    order = Window.partitionBy("player_id").orderBy("score_week")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col("present"), F.col("score_week"))).over(before)
    marked = F.max(F.when(F.col("mark"), F.col("score_week"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    affected = line.withColumns({"last": last, "marked": marked}).filter(
        F.col("mark") | (F.col("marked") >= F.col("last")) | (F.col("last").isNull() & F.col("marked").isNotNull()))
    affected = sized(materialize(affected.select("player_id", F.col("score_week").alias("week_start"), "last"),
                                 scratch_dir(spark, "affected")))
    needed = affected.select("player_id", F.explode(F.array("week_start", "last")).alias("score_week")).dropna().distinct()
    months = partitions_of(needed.select(year_month("score_week").alias("m")), "m")
    cut = in_partitions(table(spark, f"{folder}/development_score"), "score_month", months).drop("score_month", "calculated_at")
    lines = marts.weekly_digest(cut.join(needed, ["player_id", "score_week"], "left_semi"))
    # A week before the affected ones is there for its score alone.
    fresh = lines.join(affected.select("player_id", "week_start"), ["player_id", "week_start"], "left_semi")
    replace_grains(calculated(fresh, now), affected, f"{folder}/weekly_digest", ["player_id", "week_start"], "week_start")


def _report(folder: str, months: DataFrame, now: Column | None) -> None:
    """Reports of the touched players and months, from the partitions of these months."""
    spark, values = months.sparkSession, partitions_of(months, "report_month")

    def within(name: str, partition: str) -> DataFrame:
        rows = _cut(spark, f"{folder}/{name}", partition, values)
        return rows.join(months.withColumnRenamed("report_month", partition), ["player_id", partition], "left_semi")

    report = marts.monthly_report(within("fct_match", "match_year_month"), within("fct_training", "session_year_month"),
                                  within("development_score", "score_month"))
    replace_grains(calculated(report, now), months, f"{folder}/monthly_report", ["player_id", "report_month"], "report_month")


def _cut(spark: SparkSession, target: str, partition: str, values: list[str | None]) -> DataFrame:
    return in_partitions(table(spark, target), partition, values)
