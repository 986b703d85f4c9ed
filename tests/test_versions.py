"""Tables replaced in one step, and what a reader sees meanwhile."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from podium.sources import readers, sinks, versions

ROWS = "id int, part string"


def test_a_reader_keeps_the_rows_it_began_with(rows, spark, tmp_path):
    target = str(tmp_path / "t")
    assert not readers.table_exists(spark, target)
    sinks.publish(rows(ROWS, (1, "a"), (2, "b")), target)
    early = readers.table(spark, target)
    # The new rows are made of the old ones, which an overwrite in place would have deleted first.
    made = sinks.publish(early.withColumn("id", F.col("id") + 10), target)
    assert as_set(early) == {(1, "a"), (2, "b")}
    assert as_set(made) == as_set(readers.table(spark, target)) == {(11, "a"), (12, "b")}


def test_a_failed_write_leaves_the_table_as_it_was(rows, spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.publish(rows(ROWS, (1, "a")), target)
    broken = rows(ROWS, (1, "a"), (2, "b")).withColumn("id", F.expr("if(id = 2, raise_error('lost'), id)").cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, target)
    assert as_set(readers.table(spark, target)) == {(1, "a")}
    assert versions.numbers(spark, target) == [1]


def test_two_writers_cannot_take_one_number(rows, spark, tmp_path):
    target = str(tmp_path / "t")
    first, second = versions.draft(target), versions.draft(target)
    for place, part in ((first, "first"), (second, "second")):
        sinks.overwrite(rows(ROWS, (1, part)), place)
    versions.record(spark, target, first, 0)
    with pytest.raises(Exception, match="(?i)exist"):
        versions.record(spark, target, second, 0)
    assert as_set(readers.table(spark, target)) == {(1, "first")}


def test_old_versions_go(rows, spark, tmp_path):
    target = str(tmp_path / "t")
    for i in range(4):
        sinks.publish(rows(ROWS, (i, "a")), target, keep=2)
    assert versions.numbers(spark, target) == [3, 4]
    assert len([f for f in os.listdir(f"{target}/_versions") if not f.startswith(".")]) == 2
    assert as_set(spark.read.parquet(versions.folder_of(spark, target, 3))) == {(2, "a")}
    with pytest.raises(ValueError):
        sinks.publish(rows(ROWS, (1, "a")), target, keep=0)
    with pytest.raises(ValueError):
        sinks.publish(rows(ROWS, (1, "a")), "a_catalog_table")


def test_other_writes_go_to_the_current_version(rows, spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.overwrite(rows(ROWS, (0, "plain")), target, ["part"])  # a plain folder may become a published one
    sinks.publish(rows(ROWS, (1, "a"), (2, "b"), (3, None)), target, ["part"])
    sinks.append(rows(ROWS, (4, "b")), target, ["part"])
    sinks.upsert_partitions(rows(ROWS, (2, "b"), (5, "c")), target, ["id"], "part")
    assert as_set(readers.table(spark, target), "id", "part") == {(1, "a"), (2, "b"), (3, None), (4, "b"), (5, "c")}
    gone = rows("id int, part string, gone boolean", (1, "a", True))
    sinks.upsert_partitions(gone, target, ["id"], "part", deleted="gone")
    assert as_set(readers.table(spark, target), "id", "part") == {(2, "b"), (3, None), (4, "b"), (5, "c")}
    sinks.overwrite(rows(ROWS, (9, "z")), target, ["part"])
    assert as_set(readers.table(spark, target), "id", "part") == {(9, "z")}


def test_an_empty_version_is_a_table(rows, spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.publish(rows(ROWS), target)
    assert readers.table_exists(spark, target) and readers.table(spark, target).count() == 0
