"""Tick files and tick streams: headerless CSV and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions import scalars as x
from tickbars.operators import ordering
from tickbars.schemas import TICK_CSV, TICK_JSON
from tickbars.settings import DEFAULT_SYMBOL

# The layout of tick files and the tag of their rows.
CSV_FIELDS = 6
CSV_TIME = "M/d/yyyy H:m:s"
CSV_SOURCE = "mock_api"

FILE_PLACE = "_file_place"


def with_line_order(scan: DataFrame) -> DataFrame:
    """Add ``arrival_seq``: 0, 1, 2, ... by file path, then by line.

    The scan itself numbers the lines of a task, where each file block lies in one piece; row counts of blocks and files are
    summed up and joined back (``ordering.dense_numbers``). Call it directly on a file scan.
    """
    marked = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return ordering.dense_numbers(marked, [["_path"], ["_at"]], "_line", "arrival_seq").drop("_path", "_at", "_line")


def with_file_place(scan: DataFrame) -> DataFrame:
    """Add what orders the files of a streamed scan: their time, path and block (see ``numbered``)."""
    return scan.select(
        "*",
        F.struct(
            F.col("_metadata.file_modification_time").alias("time"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("at"),
        ).alias(FILE_PLACE),
    )


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """Rows of a micro-batch with an arrival order: their own column, their place in the files, or as read.

    Spark packs the largest files of a micro-batch first, so the reading order is not the arrival order. Rows are numbered
    without gaps by the modification time, path and offset of their file block, inside a block in line order; without
    files, in the order of the partitions they were read in. Keep the rows persisted while the numbers are used.
    """
    if order in rows.columns:
        return rows
    marked = rows.withColumn("_line", F.monotonically_increasing_id())
    if FILE_PLACE not in rows.columns:
        return ordering.dense_numbers(marked.withColumn("_at", F.spark_partition_id()), [["_at"]], "_line", order).drop("_at", "_line")
    parts = {"_time": "time", "_path": "path", "_at": "at"}
    placed = marked.select("*", *(F.col(f"{FILE_PLACE}.{part}").alias(name) for name, part in parts.items()))
    return ordering.dense_numbers(placed, [["_time", "_path"], ["_at"]], "_line", order).drop(FILE_PLACE, "_line", *parts)


def _csv_scan(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(TICK_CSV)
        .option("comment", "#")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .csv(path)
    )


def parse_csv(rows: DataFrame, symbol: str = DEFAULT_SYMBOL, zone: str = "UTC") -> DataFrame:
    """Tick rows out of the text fields of a CSV scan, with ``readable`` false where the time cannot be read.

    A row with fewer than six fields is left out; further fields are ignored. Numbers that cannot be read are null.
    Times are wall clock in ``zone``.
    """
    # The scan keeps a line's text when its field count is off; quoted parts may hold commas of their own.
    fields = F.size(F.split(F.regexp_replace("_bad", '"[^"]*"', ""), ","))
    whole = rows.where(F.col("_bad").isNull() | (fields >= CSV_FIELDS))
    local = F.try_to_timestamp(F.concat_ws(" ", "trade_day", "trade_time"), F.lit(CSV_TIME))
    at = local if zone == "UTC" else F.to_utc_timestamp(local, zone)
    carried = [c for c in ("arrival_seq", FILE_PLACE) if c in rows.columns]
    return whole.select(
        *carried,
        F.lit(symbol).alias("symbol"),
        x.price(x.number("price")).alias("px"),
        x.price(x.number("bid")).alias("bid"),
        x.price(x.number("ask")).alias("ask"),
        x.price(x.number("size")).alias("sz"),
        F.unix_millis(at).alias("event_ts_ms"),
        F.unix_millis(F.current_timestamp()).alias("api_send_ts_ms"),
        F.unix_millis(at).alias("source_event_ts_ms"),
        F.lit(CSV_SOURCE).alias("source"),
        at.isNotNull().alias("readable"),
        F.concat_ws(",", "trade_day", "trade_time", "price", "bid", "ask", "size").alias("line"),
    )


def read_csv(spark: SparkSession, path: str, symbol: str = DEFAULT_SYMBOL, zone: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Ticks of CSV files in line order, and the lines whose time cannot be read."""
    parsed = parse_csv(with_line_order(_csv_scan(spark, path)), symbol, zone)
    ticks = parsed.where("readable").drop("readable", "line")
    return ticks, parsed.where(~F.col("readable")).select("arrival_seq", "line")


def stream_csv(spark: SparkSession, path: str, symbol: str = DEFAULT_SYMBOL, zone: str = "UTC") -> DataFrame:
    """The same files as a stream; files arrive in the order of their modification time, lines in theirs."""
    scan = (
        spark.readStream.schema(TICK_CSV)
        .option("comment", "#")
        .option("columnNameOfCorruptRecord", "_bad")
        .csv(path)
    )
    return parse_csv(with_file_place(scan), symbol, zone).where("readable").drop("readable", "line")


def decode_json(lines: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Payloads out of lines of JSON, and the lines that are not JSON objects. Blank lines count as neither."""
    schema = T.StructType([*TICK_JSON.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    kept = lines.where(F.length(F.trim(text)) > 0)
    parsed = kept.withColumn("_tick", F.from_json(text, schema, options))
    something = F.coalesce(*[F.col(f"_tick.{name}").cast("string") for name in TICK_JSON.fieldNames()]).isNotNull()
    usable = F.col("_tick._corrupt").isNull() | something
    carried = [c for c in lines.columns if c != text]
    payload = [F.col(f"_tick.{n}").alias(n) for n in TICK_JSON.fieldNames()]
    return parsed.where(usable).select(*carried, *payload), parsed.where(~usable).select(*carried, text)


def read_ndjson(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Payloads of JSON-lines files in line order, and the malformed lines."""
    return decode_json(with_line_order(spark.read.text(path)))


def stream_ndjson(spark: SparkSession, path: str, arrival: Column | None = None) -> DataFrame:
    """Payloads of JSON-lines files as a stream; malformed lines are skipped.

    ``arrival`` gives the arrival order where the source has one. Without it the streaming stages number the rows
    of each micro-batch by file time, path and line.
    """
    scan = spark.readStream.text(path)
    return decode_json(with_file_place(scan) if arrival is None else scan.withColumn("arrival_seq", arrival))[0]
