"""The same windows with Spark's own watermark, which is one for the whole query.

Faster than the per-symbol stages and right when symbols keep pace with each other; a symbol that falls behind the
newest one by more than the allowed lateness loses rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators.bins import finish_bins
from tickbars.operators.bars import finish_bars
from tickbars.settings import BIN_MS, MAX_LATE_MS, SECOND_MS


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def bins(ticks: DataFrame, bin_ms: int = BIN_MS, max_late_ms: int = MAX_LATE_MS, ingest: Column | None = None) -> DataFrame:
    """Bins of a tick stream in append mode: a bin comes out once the watermark has passed its end."""
    timed = ticks.withColumn("event_time", x.ms_to_timestamp("event_ts_ms")).withWatermark(
        "event_time", f"{max_late_ms} milliseconds"
    )
    folded = timed.groupBy(F.window("event_time", f"{bin_ms} milliseconds"), "symbol").agg(
        F.expr("min_by(px, arrival_seq) AS open"),
        F.expr("max(px) AS high"),
        F.expr("min(px) AS low"),
        F.expr("max_by(px, arrival_seq) AS close"),
        F.expr("CAST(sum(sz) AS DECIMAL(38,6)) AS volume"),
        F.expr("CAST(sum(px * sz) AS DECIMAL(38,6)) AS notional"),
        F.expr("count(1) AS trade_count"),
        F.expr("0L AS max_lateness_ms"),
        F.expr("min(api_send_ts_ms) AS api_send_ts_ms"),
        F.expr("min(source_event_ts_ms) AS source_event_ts_ms"),
    )
    return finish_bins(folded.withColumn("start_ts_ms", _ms(F.col("window.start"))).drop("window"), bin_ms, ingest)


def bars(bin_rows: DataFrame, max_late_ms: int = MAX_LATE_MS, ingest: Column | None = None) -> DataFrame:
    """One-second bars of a bin stream in append mode; re-delivered bins count once."""
    timed = bin_rows.withColumn("start_time", x.ms_to_timestamp("start_ts_ms")).withWatermark(
        "start_time", f"{max_late_ms} milliseconds"
    )
    once = timed.dropDuplicatesWithinWatermark(["bin_id"])
    folded = once.groupBy(F.window("start_time", f"{SECOND_MS} milliseconds"), "symbol").agg(
        F.expr("min_by(open, start_ts_ms) AS open"),
        F.expr("max(high) AS high"),
        F.expr("min(low) AS low"),
        F.expr("max_by(close, start_ts_ms) AS close"),
        F.expr("CAST(sum(volume) AS DECIMAL(38,6)) AS volume"),
        F.expr("CAST(sum(notional) AS DECIMAL(38,6)) AS notional"),
        F.expr("count(1) AS bin_count"),
        F.expr("0L AS max_lateness_ms"),
        F.expr("min(api_send_ts_ms) AS api_send_ts_ms"),
        F.expr("min(source_event_ts_ms) AS source_event_ts_ms"),
    )
    return finish_bars(folded.withColumn("bar_start", _ms(F.col("window.start"))).drop("window"), ingest)


def minutes(ticks: DataFrame, max_late_ms: int = MAX_LATE_MS) -> DataFrame:
    """Seconds and minutes of a tick stream in one query, the second window chained to the first."""
    timed = ticks.withColumn("event_time", x.ms_to_timestamp("event_ts_ms")).withWatermark(
        "event_time", f"{max_late_ms} milliseconds"
    )
    seconds = timed.groupBy(F.window("event_time", "1 second"), "symbol").agg(
        F.expr("min_by(px, arrival_seq) AS open"),
        F.expr("max(px) AS high"),
        F.expr("min(px) AS low"),
        F.expr("max_by(px, arrival_seq) AS close"),
        F.expr("CAST(sum(sz) AS DECIMAL(38,6)) AS volume"),
        F.expr("CAST(sum(px * sz) AS DECIMAL(38,6)) AS notional"),
    )
    second_ms = seconds.withColumn("second_ms", _ms(F.col("window.start")))
    folded = second_ms.groupBy(F.window("window", "1 minute"), "symbol").agg(
        F.expr("min_by(open, second_ms) AS open"),
        F.expr("max(high) AS high"),
        F.expr("min(low) AS low"),
        F.expr("max_by(close, second_ms) AS close"),
        F.expr("CAST(sum(volume) AS DECIMAL(38,6)) AS volume"),
        F.expr("CAST(sum(notional) AS DECIMAL(38,6)) AS notional"),
        F.expr("count(1) AS source_count"),
    )
    return folded.withColumn("start_ts_ms", _ms(F.col("window.start"))).drop("window")
