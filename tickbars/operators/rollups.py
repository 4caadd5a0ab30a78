"""One-minute bars, and five-minute bars by count and by clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators import ordering
from tickbars.operators.bars import GRAIN, by_grain
from tickbars.operators.bins import wall_clock_ms
from tickbars.schemas import PRICE, WIDE
from tickbars.settings import DAY_MS, FIVE_MINUTES_MS, FLUSH_MINUTES, MINUTE_MS, SETTLE_GRACE_MS, UNKNOWN_SYMBOL

# Key suffixes of the rollups.
MINUTE_SUFFIX = "60s"
FIVE_MINUTE_SUFFIX = "300s"


def with_defaults(bars: DataFrame, ingest: Column | None = None) -> DataFrame:
    """Fill what a bar message may leave out; a bar without a positive start is dropped."""
    opened = F.coalesce("open", "close", F.lit(0).cast(PRICE))
    return (
        bars.where(F.col("start_ts_ms") > 0)
        .withColumn("symbol", F.coalesce(x.non_blank("symbol"), F.lit(UNKNOWN_SYMBOL)))
        .withColumn("open", opened)
        .withColumn("high", F.coalesce("high", "open"))
        .withColumn("low", F.coalesce("low", "open"))
        .withColumn("close", F.coalesce("close", "open"))
        .withColumn("volume", F.coalesce("volume", F.lit(0).cast(PRICE)))
        .withColumn("notional", F.coalesce("notional", (F.col("close") * F.col("volume")).cast(WIDE)))
        .withColumn("ingest_ts_ms", F.coalesce("ingest_ts_ms", wall_clock_ms() if ingest is None else ingest))
    )


def _fold(bars: DataFrame, start: Column, count: Column, order: str) -> DataFrame:
    rows = bars if GRAIN in bars.columns else by_grain(bars)
    return rows.groupBy("symbol", GRAIN, start.alias("bar_start")).agg(*_ohlc(order), count.alias("source_count"))


def _ohlc(order: str) -> list[Column]:
    return [
        F.expr(f"min_by(open, {order}) AS open"),
        F.expr(f"max_by(close, {order}) AS close"),
        F.expr("max(high) AS high"),
        F.expr("min(low) AS low"),
        F.expr("CAST(sum(volume) AS DECIMAL(38,6)) AS volume"),
        F.expr("CAST(sum(notional) AS DECIMAL(38,6)) AS notional"),
        F.expr("max(ingest_ts_ms) AS ingest_ts_ms"),
        F.expr("count(1) AS _rows"),
    ]


def minute_bars(bars: DataFrame, order: str = "start_ts_ms", keep_grain: bool = False) -> DataFrame:
    """One bar per symbol and minute out of one-second bars. A late second joins its minute, it replaces nothing."""
    folded = _fold(bars, x.floor_ms("start_ts_ms", MINUTE_MS), F.count(F.lit(1)), order)
    extra = [GRAIN] if keep_grain else []
    return folded.selectExpr(
        f"format_string('{x.ID_FORMAT}-{MINUTE_SUFFIX}', symbol, bar_start) AS bar_id",
        "symbol",
        "bar_start AS start_ts_ms",
        f"bar_start + {MINUTE_MS} AS end_ts_ms",
        "open",
        "close",
        "high",
        "low",
        "volume",
        "notional",
        "ingest_ts_ms",
        "source_count",
        *extra,
    )


def with_minute_ordinal(minutes: DataFrame) -> DataFrame:
    """Number the present minutes of each symbol from 1; days are counted, not sorted together."""
    return ordering.with_ordinal(
        minutes, ["symbol"], x.floor_ms("start_ts_ms", DAY_MS), "start_ts_ms", "minute_ordinal"
    )


def minute_index(minutes: DataFrame, batch: int = FLUSH_MINUTES) -> DataFrame:
    """Position 0..batch-1 of each minute in its batch of consecutive present minutes."""
    place = F.pmod(F.col("minute_ordinal") - 1, F.lit(batch))
    return with_minute_ordinal(minutes).withColumn("minute_index", place).drop("minute_ordinal")


def counted_batches(minutes: DataFrame, batch: int = FLUSH_MINUTES) -> DataFrame:
    """One bar per ``batch`` consecutive present minutes of a symbol, full batches only.

    Missing minutes stretch the span: the bar starts with the first minute and ends with the last one.
    """
    number = F.floor((F.col("minute_ordinal") - 1) / F.lit(batch))
    folded = (
        with_minute_ordinal(minutes)
        .groupBy("symbol", number.alias("_batch"))
        .agg(
            F.min("start_ts_ms").alias("start_ts_ms"),
            F.max("end_ts_ms").alias("end_ts_ms"),
            *_ohlc("start_ts_ms"),
            F.sum("source_count").alias("source_count"),
        )
        .where(F.col("_rows") == batch)
        .withColumnRenamed("_rows", "minute_count")
    )
    return folded.select(x.series_id("symbol", "start_ts_ms", FIVE_MINUTE_SUFFIX).alias("bar_id"), *_five_minute())


def aligned_five_minutes(minutes: DataFrame) -> DataFrame:
    """One bar per symbol and clock-aligned five minutes."""
    folded = _fold(minutes, F.col(GRAIN), F.sum("source_count"), "start_ts_ms")
    return (
        folded.withColumn("start_ts_ms", F.col("bar_start"))
        .withColumn("end_ts_ms", F.col("bar_start") + FIVE_MINUTES_MS)
        .withColumnRenamed("_rows", "minute_count")
        .select(x.series_id("symbol", "start_ts_ms", FIVE_MINUTE_SUFFIX).alias("bar_id"), *_five_minute())
    )


def _five_minute() -> list[str]:
    return [
        "symbol",
        "start_ts_ms",
        "end_ts_ms",
        "open",
        "close",
        "high",
        "low",
        "volume",
        "notional",
        "ingest_ts_ms",
        "minute_count",
        "source_count",
    ]


def settled_minutes(minutes: DataFrame, now_ms: int, grace_ms: int = SETTLE_GRACE_MS) -> DataFrame:
    """Minutes that ended at least ``grace_ms`` before ``now_ms`` and may be closed without another bar."""
    return minutes.where(F.col("end_ts_ms") <= F.lit(now_ms - grace_ms))
