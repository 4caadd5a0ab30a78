"""Fold accepted ticks into fixed-width bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.schemas import PRICE
from tickbars.settings import BIN_MS, UNKNOWN_SYMBOL

# Fixed value: the source tag the bin contract demands.
BIN_SOURCE = "replay"

BIN_COLUMNS = [
    "bin_id",
    "symbol",
    "start_ts_ms",
    "end_ts_ms",
    "window_ms",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "notional",
    "trade_count",
    "max_lateness_ms",
    "api_send_ts_ms",
    "source_event_ts_ms",
    "ingest_ts_ms",
    "source",
]


def wall_clock_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def fold_ticks(
    ticks: DataFrame, bin_ms: int = BIN_MS, ingest: Column | None = None, order: str = "arrival_seq"
) -> DataFrame:
    """One bin per symbol and window. First and last price follow ``order``, by default the arrival order.

    Sums are exact decimals, so they do not depend on the order in which tasks finish; the aggregate combines on
    the map side, so a crowded bin costs one row per map task.
    """
    folded = ticks.groupBy("symbol", x.floor_ms("event_ts_ms", bin_ms).alias("start_ts_ms")).agg(
        F.expr(f"min_by(px, {order}) AS open"),
        F.expr("max(px) AS high"),
        F.expr("min(px) AS low"),
        F.expr(f"max_by(px, {order}) AS close"),
        F.expr("CAST(sum(sz) AS DECIMAL(38,6)) AS volume"),
        F.expr("CAST(sum(px * sz) AS DECIMAL(38,6)) AS notional"),
        F.expr("count(1) AS trade_count"),
        F.expr("max(lateness_ms) AS max_lateness_ms"),
        F.expr("min(api_send_ts_ms) AS api_send_ts_ms"),
        F.expr("min(source_event_ts_ms) AS source_event_ts_ms"),
    )
    return finish_bins(folded, bin_ms, ingest)


def finish_bins(folded: DataFrame, bin_ms: int = BIN_MS, ingest: Column | None = None) -> DataFrame:
    """Add id, end, width, emission time and source to folded bins."""
    identified = folded.selectExpr(
        f"format_string('{x.ID_FORMAT}', symbol, start_ts_ms) AS bin_id",
        "*",
        f"start_ts_ms + {bin_ms} AS end_ts_ms",
        f"{bin_ms}L AS window_ms",
        f"'{BIN_SOURCE}' AS source",
    )
    emitted = wall_clock_ms() if ingest is None else ingest
    return identified.withColumn("ingest_ts_ms", emitted).select(*BIN_COLUMNS)


def dedupe(rows: DataFrame, key: str = "bin_id") -> DataFrame:
    """One row per key out of re-delivered copies; copies collapse on the map side first."""
    return rows.dropDuplicates([key])


def with_defaults(bins: DataFrame, bin_ms: int = BIN_MS) -> DataFrame:
    """Fill what a bin message may leave out; a bin without open or start is dropped."""
    opened = F.col("open")
    return (
        bins.where(opened.isNotNull() & F.col("start_ts_ms").isNotNull())
        .withColumn("symbol", F.coalesce(x.non_blank("symbol"), F.lit(UNKNOWN_SYMBOL)))
        .withColumn("end_ts_ms", F.coalesce("end_ts_ms", F.col("start_ts_ms") + bin_ms))
        .withColumn("high", F.coalesce("high", opened))
        .withColumn("low", F.coalesce("low", opened))
        .withColumn("close", F.coalesce("close", opened))
        .withColumn("volume", F.coalesce("volume", F.lit(0).cast(PRICE)))
        .withColumn("notional", F.coalesce("notional", F.lit(0).cast(PRICE)))
    )
