"""Read the given event table as market ticks and quotes.

The events carry no prices of their own market, so each column is mapped by a fixed rule onto the tick layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.schemas import EVENTS

# Fixed values of the mapping from events to ticks.
SYMBOL_OF_EVENT = {"click": "WDC", "view": "AAPL", "purchase": "MSFT", "signup": "TSLA", "error": "ZZZ"}
SOURCE_EPOCH_MS = 1_704_067_200_000
SESSION_EPOCH_MS = 1_735_822_800_000
TIME_SCALE = 600
DISORDER_STEP = 7_919
DISORDER_MS = 1_500
ARRIVAL_STRIDE = 2_000_000_000_000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table, with its layout given so that no job has to look at the files first."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _symbol() -> str:
    pairs = ", ".join(f"'{event}', '{symbol}'" for event, symbol in SYMBOL_OF_EVENT.items())
    return f"element_at(map({pairs}), event_type)"


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with source and event time, arrival order, symbol and the number in their properties.

    Arrival follows event time with a fixed disorder of up to 1.5 s; the event id breaks ties, so it is unique.
    """
    source_ms = "unix_millis(CAST(ts AS TIMESTAMP))"
    return (
        read_events(spark, sf_dir)
        .selectExpr(
            "*",
            f"{source_ms} AS source_ms",
            f"{SESSION_EPOCH_MS} + ({source_ms} - {SOURCE_EPOCH_MS}) div {TIME_SCALE} AS event_ms",
            f"{_symbol()} AS symbol",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
        )
        .selectExpr(
            "*",
            f"(event_ms - {SESSION_EPOCH_MS} + event_id * {DISORDER_STEP} % {DISORDER_MS}) * {ARRIVAL_STRIDE} + event_id"
            " AS arrival_seq",
        )
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks: arrival_seq, symbol, px, sz, event and source times, API send time (sometimes missing)."""
    return _timed(spark, sf_dir).selectExpr(
        "arrival_seq",
        "symbol",
        "CAST(value AS DECIMAL(18,6)) AS px",
        "CAST(value - 0.01D AS DECIMAL(18,6)) AS bid",
        "CAST(value + 0.01D AS DECIMAL(18,6)) AS ask",
        "CAST(k AS DECIMAL(18,6)) AS sz",
        "event_ms AS event_ts_ms",
        "IF(event_id % 17 <> 0, event_ms + 20 + event_id % 30, NULL) AS api_send_ts_ms",
        "source_ms AS source_event_ts_ms",
        "'mock_api' AS source",
    )


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ticks as loosely typed messages: text numbers, fractional seconds, holes."""
    return _timed(spark, sf_dir).selectExpr(
        "arrival_seq",
        "IF(k <> 13, symbol, '') AS symbol",
        "IF(k <> 7, CAST(value AS STRING), NULL) AS px",
        "CAST(value - 0.01D AS STRING) AS bid",
        "IF(k <> 19, CAST(value + 0.01D AS STRING), 'oops') AS ask",
        "IF(k <> 23, CAST(k AS DOUBLE), NULL) AS sz",
        "IF(k <> 11, CAST(CAST(event_ms / 1000.0D AS DECIMAL(18,6)) AS STRING), NULL) AS event_ts",
        "IF(k <> 29, concat(CAST(event_ms AS STRING), '.75'), 'soon') AS api_send_ts_ms",
        "'mock_api' AS source",
        "CAST(CAST(source_ms / 1000.0D AS DECIMAL(18,6)) AS STRING) AS source_event_ts",
        "IF(k >= 50, CAST(source_ms AS STRING), NULL) AS source_event_ts_ms",
    )


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote snapshots with missing prices and zero sizes."""
    return _timed(spark, sf_dir).selectExpr(
        "event_id AS quote_id",
        "symbol",
        "IF(k >= 20, value, NULL) AS last_price",
        "CAST(IF(k % 3 <> 0, CAST(value AS DECIMAL(18,6)) - 0.01, NULL) AS DOUBLE) AS bid",
        "CAST(IF(k % 4 <> 0, CAST(value AS DECIMAL(18,6)) + 0.01, NULL) AS DOUBLE) AS ask",
        "CAST(k % 5 AS DOUBLE) AS last_size",
        "CAST(k % 7 AS DOUBLE) AS bid_size",
        "CAST(k % 11 AS DOUBLE) AS ask_size",
        "event_ms AS quote_ts_ms",
    )
