"""Which version of a folder counts: whole versions side by side, and a record that names the last one.

A version is written under a name of its own below ``_versions``, where nobody looks. It becomes the table when a
record appears below ``_published``, under the number after the last: one file, moved into place, that holds the
version's name. Readers take the record with the largest number. Two writers cannot both take a number; the second fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_VERSIONS, _RECORDS = "_versions", "_published"


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Published versions that are still kept, oldest first; none for a plain folder."""
    records = _path(spark, folder, _RECORDS)
    files = _files(spark, records)
    if not files.exists(records):
        return []
    return sorted(int(entry.getPath().getName()) for entry in files.listStatus(records))


def folder_of(spark: SparkSession, folder: str, number: int) -> str:
    """Where the rows of a published version lie."""
    record = _path(spark, folder, _RECORDS, f"{number:09d}")
    stream = _files(spark, record).open(record)
    try:
        return f"{folder.rstrip('/')}/{_VERSIONS}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def current(spark: SparkSession, folder: str) -> str:
    """Folder of the last published version; a plain folder is its own."""
    known = numbers(spark, folder)
    return folder_of(spark, folder, known[-1]) if known else folder


def draft(folder: str) -> str:
    """A new folder to write a version to."""
    return f"{folder.rstrip('/')}/{_VERSIONS}/{uuid.uuid4().hex}"


def record(spark: SparkSession, folder: str, version: str, after: int) -> None:
    """Make the written ``version`` the table, unless another was published behind number ``after`` meanwhile."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    note, final = _path(spark, version + ".record"), _path(spark, folder, _RECORDS, f"{after + 1:09d}")
    files = _files(spark, note)
    files.mkdirs(final.getParent())
    stream = files.create(note)
    stream.write(version.rsplit("/", 1)[1].encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(note.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(note, final, no_overwrite)
    except Exception:
        files.delete(note, False)
        raise


def retire(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete versions older than the last ``keep``; whoever reads one of those has had that many publications' time."""
    for number in numbers(spark, folder)[:-keep]:
        rows, note = folder_of(spark, folder, number), _path(spark, folder, _RECORDS, f"{number:09d}")
        _files(spark, note).delete(note, False)
        _files(spark, note).delete(_path(spark, rows), True)
