"""Bin and bar messages: Kafka topics, files of the same messages, and JSON-lines logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.schemas import BAR_1S, BIN, PRICE
from tickbars.sources.ticks import with_line_order

# Topics.
BIN_TOPIC = "ticks.raw"
BAR_TOPIC = "ticks.agg.1s"


def kafka_stream(
    spark: SparkSession, brokers: str, topic: str, starting: str, max_records: int | None = None
) -> DataFrame:
    """A topic as key, value, offset and timestamp (needs Spark's Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load()


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Records out of messages; empty and malformed values are skipped.

    The message's offset becomes ``arrival_seq`` and its broker time ``record_ts_ms`` where there are such columns.
    Numbers are exact decimals from here on, as everywhere in the pipeline.
    """
    parsed = messages.withColumn("_record", F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"}))
    fields = [
        F.col(f"_record.{f.name}").cast(PRICE if isinstance(f.dataType, T.DoubleType) else f.dataType).alias(f.name)
        for f in schema.fields
    ]
    extra = []
    if "offset" in messages.columns:
        extra.append(F.col("offset").alias("arrival_seq"))
    if "timestamp" in messages.columns:
        extra.append(F.unix_millis("timestamp").alias("record_ts_ms"))
    if "arrival_seq" in messages.columns:
        extra.append(F.col("arrival_seq"))
    anything = F.coalesce(*[F.col(f"_record.{f.name}").cast("string") for f in schema.fields])
    return parsed.where(anything.isNotNull()).select(*fields, *extra)


def bin_stream(spark: SparkSession, brokers: str, topic: str = BIN_TOPIC) -> DataFrame:
    """Bins from the start of the topic."""
    return decode(kafka_stream(spark, brokers, topic, "earliest"), BIN)


def bar_stream(spark: SparkSession, brokers: str, topic: str = BAR_TOPIC, max_records: int | None = None) -> DataFrame:
    """Bars from now on, at most ``max_records`` per micro-batch (None for no bound)."""
    return decode(kafka_stream(spark, brokers, topic, "latest", max_records), BAR_1S)


def file_messages(spark: SparkSession, path: str) -> DataFrame:
    """Key and value messages stored as JSON lines, as a stream: the shape of a topic without a broker."""
    return spark.readStream.schema("key STRING, value STRING, arrival_seq BIGINT").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None) -> DataFrame:
    """Records of a JSON-lines log; a malformed line fails the job. ``limit`` keeps the first records in line order."""
    scan = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if limit is None:
        return scan
    return with_line_order(scan).orderBy("arrival_seq").limit(limit).drop("arrival_seq")
