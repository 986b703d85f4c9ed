"""Readers. Batch and stream readers take a declared schema and never infer one."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.schemas import ALIAS_SEED, BINARY_FILES
from podium.sources import versions


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 merge_schema: bool = False) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", merge_schema)
    return reader.parquet(path)


def seed(spark: SparkSession, path: str, schema: T.StructType = ALIAS_SEED) -> DataFrame:
    """Lookup table kept as a CSV file; cell padding is dropped."""
    return (spark.read.schema(schema).option("header", True)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))


def stream_csv(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.csv") -> DataFrame:
    return (spark.readStream.schema(schema).option("header", True)
            .option("pathGlobFilter", glob).csv(folder))


def stream_binary(spark: SparkSession, folder: str, glob: str = "*.png") -> DataFrame:
    return (spark.readStream.format("binaryFile").schema(BINARY_FILES)
            .option("pathGlobFilter", glob).load(folder))


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """Follow the files appended to a landing table."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_kafka(spark: SparkSession, servers: str, topic: str, schema: T.StructType,
                 fail_on_data_loss: bool = True, offsets_per_batch: int | None = None) -> DataFrame:
    """JSON events of a topic, with their offset and partition. Needs the Kafka connector jar.

    ``fail_on_data_loss`` says what happens to offsets that the topic no longer holds: the query fails, or goes on
    behind them. The raw records for :func:`decode_or_reject` are those of :func:`kafka_records`.
    """
    return decode_events(kafka_records(spark, servers, topic, fail_on_data_loss, offsets_per_batch), schema)


def kafka_records(spark: SparkSession, servers: str, topic: str, fail_on_data_loss: bool = True,
                  offsets_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**{
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower()})
    return (reader.option("maxOffsetsPerTrigger", offsets_per_batch) if offsets_per_batch else reader).load()


def decode_events(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the JSON ``value`` of each record, plus where the record came from."""
    return (raw.select(F.from_json(F.col("value").cast("string"), schema).alias("_event"),
                       F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"))
            .select("_event.*", "kafka_offset", "kafka_partition"))


def decode_or_reject(raw: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Decoded events as in :func:`decode_events`, and the records that hold none: (value, reason, offset, partition).

    A record without a value, with text that is no JSON object, or with a field of another type than declared is
    rejected whole, as it came. Works on a batch and, in ``foreachBatch``, on a stream.
    """
    text = F.col("value").cast("string")
    channel = T.StructType([*schema.fields, T.StructField("_unread", T.StringType())])
    parsed = raw.select(
        text.alias("value"), F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"),
        F.from_json(text, channel, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread"}).alias("_event"))
    reason = (F.when(F.col("value").isNull(), "no value")
              .when(F.col("_event").isNull() | F.col("_event._unread").isNotNull(), "not readable"))
    told = parsed.withColumn("reason", reason)
    good = told.filter(F.col("reason").isNull()).select("_event.*", "kafka_offset", "kafka_partition").drop("_unread")
    return good, told.filter(F.col("reason").isNotNull()).select("value", "reason", "kafka_offset", "kafka_partition")


def table(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """A table by catalog name, or a Parquet folder by path, whose schema may be given.

    Of a folder with published versions it is the last one, also if others are published before it is read.
    """
    return read_parquet(spark, versions.current(spark, target), schema) if is_path(target) else spark.table(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    if not is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(versions.current(spark, target))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def table_or_empty(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    if table_exists(spark, target):
        return table(spark, target)
    return spark.createDataFrame([], schema)


def rows_to_df(spark: SparkSession, rows: list[dict[str, Any]], schema: T.StructType) -> DataFrame:
    """A handful of driver rows under a declared schema; absent fields become null."""
    return spark.createDataFrame([tuple(r.get(name) for name in schema.names) for r in rows], schema)


def query(spark: SparkSession, sql: str, **args: Any) -> DataFrame:
    """SQL text with named parameters (``:name``), never interpolated."""
    return spark.sql(sql, args=args)


def load_contract(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)["contract"]


def is_path(target: str) -> bool:
    return "/" in target
