"""Loads from real files: idempotent, equal in batch and stream."""

from __future__ import annotations

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from podium.operators.conform import conform
from podium.plans import bronze
from podium.schemas import EXTRACTION_FAILURES, RAW_MATCHES, RAW_STUDENTS, RAW_TRAINING, SESSION_FILES, declare
from podium.session import scratch_dir
from podium.sources import readers, sinks
from podium.streaming import intake


@pytest.fixture
def folders(tmp_path):
    names = ("landing", "target", "checkpoint")
    (tmp_path / "landing").mkdir()
    return [str(tmp_path / n) for n in names]


HEADER = ",".join(RAW_STUDENTS.names)


def student(id, **more):
    row = {"student_id": id, "full_name": f"Name {id}", "age_group": "U12", "competition_level": "competitive", **more}
    return ",".join(str(row.get(c, "")) for c in RAW_STUDENTS.names)


def drop(folder, name, *lines):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def test_student_stream_is_idempotent(spark, folders):
    landing, target, checkpoint = folders
    drop(landing, "students.csv", student("a"), student("a"), student("b", utr_rating=17), student("c", competition_level="social"),
         student("d", utr_rating=16.5), student("", full_name="nobody"))
    intake.ingest_students(spark, landing, target, checkpoint)
    assert as_set(readers.table(spark, target), "student_id") == {("a",), ("d",)}
    intake.ingest_students(spark, landing, target, checkpoint)  # nothing new
    assert readers.table(spark, target).count() == 2


def test_student_stream_replayed_without_its_checkpoint(spark, folders, tmp_path):
    landing, target, checkpoint = folders
    drop(landing, "students.csv", student("a"), student("b", age_group="U14"))
    intake.ingest_students(spark, landing, target, checkpoint)
    intake.ingest_students(spark, landing, target, str(tmp_path / "lost"))
    stored = readers.table(spark, target)
    assert stored.count() == 2 and as_set(stored.filter("age_group = 'U14'"), "student_id") == {("b",)}
    row = stored.filter("student_id = 'a'").first()
    assert row["_source_file"].endswith("students.csv") and row["_pipeline_version"] == "v1.0"


def test_page_images(spark, folders, tmp_path):
    landing, target, checkpoint = folders
    names = ["202503151400_alex_match_1.png", "202503151400_alex_match_2.png", "202513991400_alex_match_1.png",
             "202503151400_alex_training_1.txt", "notes.png"]
    for i, name in enumerate(names):
        with open(f"{landing}/{name}", "wb") as f:
            f.write(b"x" * (i + 1))
    intake.ingest_session_files(spark, landing, target, checkpoint)
    stored = readers.table(spark, target)
    assert stored.columns == SESSION_FILES.names
    assert as_set(stored, "session_id", "page_number", "file_size_bytes") == {
        ("202503151400_alex_match", 1, 1), ("202503151400_alex_match", 2, 2)}
    shutil.copy(f"{landing}/{names[0]}", f"{landing}/202503161400_kim_training_1.png")
    intake.ingest_session_files(spark, landing, target, checkpoint)
    assert readers.table(spark, target).count() == 3


def test_batch_parse_equals_stream(spark, folders):
    landing, target, checkpoint = folders
    for day in range(1, 6):
        with open(f"{landing}/2025030{day}1400_alex_match_{day}.png", "wb") as f:
            f.write(b"x")
    intake.ingest_session_files(spark, landing, target, checkpoint)
    batch = intake.session_file_rows(spark.read.format("binaryFile").load(landing).drop("content"), "v1.0")
    cols = [c for c in SESSION_FILES.names if c != "_ingested_at"]
    assert as_set(batch, *cols) == as_set(readers.table(spark, target), *cols)


def test_intake_events_over_several_batches(spark, folders):
    landing, target, checkpoint = folders
    schema = declare("STRING intake_id full_name submitted_at")
    rows = [(f"i{n % 3}", f"Player {n % 3}", f"2024-01-{n:02d}") for n in range(1, 10)]
    spark.createDataFrame(rows, schema).repartition(5).write.mode("append").parquet(landing)
    events = conform(readers.stream_table(spark, landing, schema, files_per_batch=1), RAW_STUDENTS)
    intake.ingest_intake(events, target, checkpoint, now=F.lit(dt.datetime(2024, 2, 1)).cast("timestamp"))
    stored = readers.table(spark, target)
    assert stored.count() == 3 and stored.select("student_id").distinct().count() == 3
    assert as_set(stored, "is_current", "valid_to", "valid_from") == {(True, None, dt.datetime(2024, 2, 1))}


def test_empty_batch_writes_nothing(spark, folders):
    landing, target, checkpoint = folders
    drop(landing, "students.csv", student("a", utr_rating=99))
    intake.ingest_students(spark, landing, target, checkpoint)
    assert not readers.table_exists(spark, target)


def test_match_load_rerun_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "matches")
    rows = [("m1", "a", dt.date(2024, 1, 1), 1, 1), ("m1", "a", dt.date(2024, 1, 1), 1, 1), ("m2", "a", None, 1, 1),
            ("m3", "a", dt.date(2024, 1, 1), -1, 1), ("m4", None, dt.date(2024, 1, 1), 1, 1)]
    incoming = spark.createDataFrame(rows, "match_id string, player_id string, match_date date, winners int, unforced_errors int")
    for expected in (1, 0):
        existing = readers.table(spark, target) if readers.table_exists(spark, target) else None
        fresh = bronze.ingest_matches(incoming, existing, "file.parquet")
        assert fresh.count() == expected
        sinks.append(fresh, target)
    assert dict(readers.table(spark, target).dtypes)["winners"] == "bigint"


def test_training_load_preserves_extracted_rows(spark):
    old = conform(spark.createDataFrame(
        [("real", "v1.0", 0.1), ("gone", "synthetic", 0.2), ("unknown", None, 0.3)],
        "session_id string, prompt_version string, shots_in double"), RAW_TRAINING)
    new = spark.createDataFrame([("n1", "synthetic", "0.9"), ("n1", "synthetic", "0.9")],
                                "session_id string, prompt_version string, shots_in string")
    state = bronze.ingest_training(new, old, "file.parquet")
    assert as_set(state, "session_id", "shots_in") == {("real", 0.1), ("unknown", 0.3), ("n1", 0.9)}
    assert state.count() == 3


def test_sinks(spark, tmp_path):
    target = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, part string")
    sinks.overwrite(a, target, ["part"])
    sinks.overwrite(a.limit(1), target, ["part"])
    assert readers.table(spark, target).count() == 1  # the whole table is replaced
    sinks.upsert_partitions(spark.createDataFrame([(1, "x"), (3, "z")], "id int, part string"), target, ["id"], "part")
    sinks.upsert_partitions(spark.createDataFrame([(3, "z"), (4, "z")], "id int, part string"), target, ["id"], "part")
    assert as_set(readers.table(spark, target), "id", "part") == {(1, "x"), (3, "z"), (4, "z")}


def test_upsert_into_the_null_partition(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.overwrite(spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", None)], "id int, v string, part string"),
                    target, ["part"])
    sinks.upsert_partitions(spark.createDataFrame([(2, "new", None)], "id int, v string, part string"), target, ["id"], "part")
    assert as_set(readers.table(spark, target), "id", "v", "part") == {(1, "a", "x"), (2, "new", None), (3, "c", None)}


def test_upsert_into_a_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS podium_upsert")
    try:
        for rows in ([(1, "x", "a"), (2, "y", "b")], [(2, "y", "new"), (3, "y", "c")]):
            sinks.upsert_partitions(spark.createDataFrame(rows, "id int, part string, v string"), "podium_upsert", ["id"], "part")
        assert as_set(readers.table(spark, "podium_upsert"), "id", "v", "part") == {(1, "a", "x"), (2, "new", "y"), (3, "c", "y")}
    finally:
        spark.sql("DROP TABLE IF EXISTS podium_upsert")


def test_catalog_tables(spark):
    spark.sql("DROP TABLE IF EXISTS podium_t")
    try:
        sinks.insert_new(spark.createDataFrame([(1, "a")], "id int, v string"), "podium_t", ["id"], ["v"])
        sinks.insert_new(spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string"), "podium_t", ["id"], ["v"])
        assert as_set(readers.table(spark, "podium_t")) == {(1, "a"), (2, "c")}
    finally:
        spark.sql("DROP TABLE IF EXISTS podium_t")


def test_readers(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("alias,canonical_player_id,alias_source\nyi     , yi    , filename\n")
    assert as_set(readers.seed(spark, str(tmp_path / "seed.csv"))) == {("yi", "yi", "filename")}
    assert readers.table_or_empty(spark, str(tmp_path / "none"), EXTRACTION_FAILURES).schema == EXTRACTION_FAILURES
    assert not readers.table_exists(spark, "no_such_table")
    (tmp_path / "c.yml").write_text("contract: {name: t, sla: {min_rows: 2}, schema: []}")
    assert readers.load_contract(str(tmp_path / "c.yml"))["sla"] == {"min_rows": 2}
    hostile = "x' OR '1'='1"
    assert readers.query(spark, "SELECT :p AS p", p=hostile).first()["p"] == hostile
    decoded = readers.decode_events(
        spark.createDataFrame([(bytearray(json.dumps({"k": 1}).encode()), 5, 0)], "value binary, offset bigint, partition int"),
        declare("BIGINT k"))
    assert tuple(decoded.first()) == (1, 5, 0)


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if root:
        assert first.startswith(root.rstrip("/"))


def test_declared_match_schema_is_complete():
    assert len(RAW_MATCHES) == len(set(RAW_MATCHES.names)) == 53
