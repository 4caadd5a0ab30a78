"""Keyed JSON messages, JSON-lines files and their gzip form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_KEY = "bin_id"
BAR_KEY = "bar_id"


def _message(rows: DataFrame, key: Column) -> DataFrame:
    doubles = [
        F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in rows.schema.fields
    ]
    return rows.select(key.cast("string").alias("key"), F.to_json(F.struct(*doubles)).alias("value"))


def bin_messages(bins: DataFrame) -> DataFrame:
    """Key and compact JSON value of each bin, ready for a Kafka or file sink."""
    return _message(bins, F.col(BIN_KEY))


def bar_messages(bars: DataFrame, id_field: str = BAR_KEY) -> DataFrame:
    """The same for bars; the key comes from ``id_field`` and falls back to the bar id."""
    key = F.coalesce(F.col(id_field), F.col(BAR_KEY)) if id_field in bars.columns else F.col(BAR_KEY)
    return _message(bars, key)


def by_symbol(messages: DataFrame, symbol: Column) -> DataFrame:
    """Key messages by symbol instead, so that a topic with several partitions keeps each symbol in order."""
    return messages.withColumn("key", symbol)


def write_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    """Batch write to Kafka (needs Spark's Kafka connector on the class path)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Append rows as JSON lines."""
    rows.write.mode("append").json(path)


def append_staged(rows: DataFrame, path: str) -> None:
    """Append rows as gzip-compressed JSON lines, the form the raw landing zone takes."""
    rows.write.mode("append").option("compression", "gzip").json(path)
