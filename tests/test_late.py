"""Event-time loads: late and repeated rows, over restarts and replayed batches."""

from __future__ import annotations

import datetime as dt

from conftest import as_set
from podium.sources.readers import stream_table, table
from podium.streaming import late

EVENTS = "id bigint, at timestamp, what string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def drop(spark, folder, *events):
    spark.createDataFrame(list(events), EVENTS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path):
    stream = stream_table(spark, f"{tmp_path}/in", spark.createDataFrame([], EVENTS).schema, files_per_batch=1)
    late.ingest_in_time(stream, f"{tmp_path}/t", f"{tmp_path}/late", f"{tmp_path}/cp", ["id"], "at", "2 days", ["at"])


def test_late_rows_go_aside_and_repeats_are_dropped(spark, tmp_path):
    drop(spark, f"{tmp_path}/in", (1, at(5), "a"), (2, at(5, 3), "b"), (1, at(5), "a"))
    run(spark, tmp_path)
    drop(spark, f"{tmp_path}/in", (1, at(5), "a"), (3, at(2), "late"), (4, at(4), "in time"), (5, None, "no time"), (6, at(9), "c"))
    drop(spark, f"{tmp_path}/in", (7, at(6), "late now"), (8, at(8), "d"), (3, at(2), "late"))
    run(spark, tmp_path)
    run(spark, tmp_path)  # nothing new
    assert as_set(late.stored_in_time(spark, f"{tmp_path}/t"), "id", "what") == {
        (1, "a"), (2, "b"), (4, "in time"), (6, "c"), (8, "d")}
    assert as_set(table(spark, f"{tmp_path}/late"), "id", "what") == {(3, "late"), (5, "no time"), (7, "late now")}


def test_a_replayed_batch_decides_as_before(spark, tmp_path):
    write = late.split_batches(f"{tmp_path}/t", f"{tmp_path}/late", f"{tmp_path}/marks", ["id"], "at", "2 days", ["at"])
    first = spark.createDataFrame([(1, at(1), "a"), (2, at(9), "b")], EVENTS)
    for _ in range(2):  # the second time its own mark is there already
        write(first, 0)
    write(spark.createDataFrame([(3, at(1), "late")], EVENTS), 1)
    write(first, 0)
    assert as_set(late.stored_in_time(spark, f"{tmp_path}/t"), "id") == {(1,), (2,)}
    assert as_set(table(spark, f"{tmp_path}/late"), "id") == {(3,)}
    assert table(spark, f"{tmp_path}/marks").count() == 2


def test_state_of_distinct_rows_follows_the_delay(spark, tmp_path):
    drop(spark, f"{tmp_path}/in", (1, at(5), "a"), (1, at(5), "a"), (2, at(5), "b"))
    drop(spark, f"{tmp_path}/in", (1, at(5, 1), "again"), (3, at(20), "c"))
    drop(spark, f"{tmp_path}/in", (4, at(21), "d"), (3, at(20), "c"))
    stream = stream_table(spark, f"{tmp_path}/in", spark.createDataFrame([], EVENTS).schema, files_per_batch=1)
    query = (late.distinct_within(stream, ["id"], "at", "2 days").writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    rows = table(spark, f"{tmp_path}/out")
    assert rows.count() == 4 and as_set(rows, "id") == {(1,), (2,), (3,), (4,)}
