"""What a dashboard asks of the bar table and of the newest ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators import ordering
from tickbars.operators.bars import BAR_SOURCE
from tickbars.schemas import PRICE
from tickbars.settings import BARS_PER_SYMBOL, DAY_MS, METRICS_WINDOW, SECOND_MS, UNKNOWN_SYMBOL

# Rows of the live table, points of the live chart, default source tag, mark for a missing value.
LIVE_ROWS = 120
LIVE_POINTS = 500
LIVE_SOURCE = "mock_api"
NO_VALUE = "–"


def serving_bars(bars: DataFrame) -> DataFrame:
    """Bars with every field a dashboard reads filled in."""
    zero = F.lit(0).cast(PRICE)
    none = F.lit(0).cast("long")
    return bars.select(
        "bar_id",
        F.coalesce("symbol", F.lit(UNKNOWN_SYMBOL)).alias("symbol"),
        F.coalesce("start_ts_ms", none).alias("start_ts_ms"),
        F.coalesce("end_ts_ms", F.coalesce("start_ts_ms", none) + SECOND_MS).alias("end_ts_ms"),
        *[F.coalesce(c, zero).alias(c) for c in ("open", "high", "low", "close", "volume", "notional")],
        F.coalesce(F.col("vwap").cast("double"), F.lit(0.0)).alias("vwap"),
        F.coalesce("bin_count", none).alias("bin_count"),
        F.coalesce("max_lateness_ms", none).alias("max_lateness_ms"),
        F.coalesce("ingest_ts_ms", "received_ts_ms").alias("ingest_ts_ms"),
        "api_send_ts_ms",
        "source_event_ts_ms",
        F.coalesce("source", F.lit(BAR_SOURCE)).alias("source"),
        "received_ts_ms",
        "record_ts_ms",
    )


def latest_n(bars: DataFrame, count: int = BARS_PER_SYMBOL, order: str = "start_ts_ms") -> DataFrame:
    """The newest ``count`` bars of each symbol, picked per day first and then among those."""
    return ordering.top_per_key(bars, ["symbol"], x.floor_ms("start_ts_ms", DAY_MS), F.col(order).desc(), count)


def latest_bar(bars: DataFrame, order: str = "start_ts_ms") -> DataFrame:
    """The newest bar of each symbol, as an aggregate over fixed-width fields."""
    fields = [
        "end_ts_ms",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "bin_count",
        "max_lateness_ms",
        "api_send_ts_ms",
        "source_event_ts_ms",
        "ingest_ts_ms",
    ]
    newest = bars.groupBy("symbol").agg(
        F.max_by("start_ts_ms", order).alias("start_ts_ms"), *[F.max_by(c, order).alias(c) for c in fields]
    )
    return newest.select(x.series_id("symbol", "start_ts_ms").alias("bar_id"), "symbol", "start_ts_ms", *fields)


def last_seconds(bars: DataFrame, seconds: int) -> DataFrame:
    """Bars that start within ``seconds`` of their symbol's newest bar.

    One pass: first against the newest bar of the symbol's day, then, with at most ``seconds`` bars left of a day,
    against the newest of all.
    """
    day = x.floor_ms("start_ts_ms", DAY_MS)
    recent = F.col("start_ts_ms") >= F.col("_newest") - seconds * SECOND_MS
    near = bars.withColumn("_newest", F.max("start_ts_ms").over(W.partitionBy("symbol", day))).where(recent)
    return near.withColumn("_newest", F.max("start_ts_ms").over(W.partitionBy("symbol"))).where(recent).drop("_newest")


def distinct_symbols(bars: DataFrame) -> DataFrame:
    return bars.select("symbol").distinct().orderBy("symbol")


def average_real_gap(bars: DataFrame) -> DataFrame:
    """Mean step between the starts of consecutive traded bars of each symbol; 0.0 below two bars.

    The steps add up to last start minus first start, so no row needs its predecessor.
    """
    traded = F.col("volume") > 0
    start = F.when(traded, F.col("start_ts_ms"))
    gaps = F.count(start) - 1
    mean = (F.max(start) - F.min(start)).cast("double") / gaps.cast("double")
    return bars.groupBy("symbol").agg(F.when(gaps > 0, mean).otherwise(F.lit(0.0)).alias("avg_real_gap_ms"))


def start_gaps(bars: DataFrame) -> DataFrame:
    """Step from each traded bar to the one before it, null for a symbol's first bar."""
    traded = bars.where(F.col("volume") > 0)
    chunked = traded.withColumn(ordering.CHUNK, x.floor_ms("start_ts_ms", DAY_MS))
    handed = ordering.carry(
        chunked,
        ["symbol"],
        ordering.CHUNK,
        [F.max("start_ts_ms").alias("_last")],
        lambda over: [F.lag("_last").over(over).alias("_before")],
    )
    inside = W.partitionBy("symbol", ordering.CHUNK).orderBy("start_ts_ms")
    previous = F.coalesce(F.lag("start_ts_ms").over(inside), F.col("_before"))
    return handed.withColumn("gap_ms", F.col("start_ts_ms") - previous).drop(ordering.CHUNK, "_before")


def gap_metrics(
    bars: DataFrame,
    now_ms: int,
    order: Sequence[str] = ("received_ts_ms",),
    window: int = METRICS_WINDOW,
    per_symbol: int = BARS_PER_SYMBOL,
) -> DataFrame:
    """Latency of the newest bars on their way to the reader, and how far the table lags behind ``now_ms``.

    API and broker gaps are averaged over the newest bars that have one. A newest bar without an API time has no
    last API gap; without a broker time its last broker gap is 0. All parts are top-k picks or plain aggregates,
    put together by one aggregate over a tagged union.
    """
    received = F.col("received_ts_ms")
    rows = bars.select(
        *dict.fromkeys((*order, "symbol", "end_ts_ms", "received_ts_ms")),
        x.at_least_zero(received - F.col("ingest_ts_ms")).alias("producer"),
        F.when(F.col("api_send_ts_ms").isNotNull(), x.at_least_zero(received - F.col("api_send_ts_ms"))).alias("api"),
        F.when(F.col("record_ts_ms").isNotNull(), x.at_least_zero(received - F.col("record_ts_ms"))).alias("broker"),
    )
    newest_first = [F.col(c).desc() for c in order]

    def tagged(frame: DataFrame, tag: str, value: Column) -> DataFrame:
        return frame.select(F.lit(tag).alias("tag"), value.cast("double").alias("value"))

    last = rows.orderBy(*newest_first).limit(1)
    parts = [
        tagged(rows.where(F.col(gap).isNotNull()).orderBy(*newest_first).limit(window), gap, F.col(gap))
        for gap in ("api", "producer", "broker")
    ]
    last_values = F.inline(
        F.array(
            *[
                F.struct(F.lit(f"last_{tag}").alias("tag"), value.cast("double").alias("value"))
                for tag, value in (
                    ("api", F.col("api")),
                    ("producer", F.col("producer")),
                    ("broker", F.coalesce("broker", F.lit(0))),
                    ("update", received),
                )
            ]
        )
    )
    parts.append(last.select(last_values))
    per = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("end_ts_ms").alias("end"))
    held = per.agg(F.sum(F.least("n", F.lit(per_symbol))).alias("held"), F.max("end").alias("end"))
    parts.append(
        held.select(
            F.inline(
                F.array(
                    F.struct(F.lit("held").alias("tag"), F.col("held").cast("double").alias("value")),
                    F.struct(F.lit("end").alias("tag"), F.col("end").cast("double").alias("value")),
                )
            )
        )
    )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)

    def one(tag: str) -> Column:
        return F.max(F.when(F.col("tag") == tag, F.col("value")))

    def mean(tag: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col("tag") == tag, F.col("value"))), F.lit(0.0))

    zero = F.lit(0.0)
    return union.agg(
        one("last_api").alias("last_api_gap_ms"),
        mean("api").alias("avg_api_gap_ms"),
        F.coalesce(one("last_producer"), zero).alias("last_producer_gap_ms"),
        mean("producer").alias("avg_producer_gap_ms"),
        F.coalesce(one("last_broker"), zero).alias("last_broker_gap_ms"),
        mean("broker").alias("avg_broker_gap_ms"),
        F.greatest(F.lit(float(now_ms)) - F.coalesce(one("end"), zero), zero).alias("backlog_ms"),
        F.coalesce(one("held"), zero).alias("bars_cached"),
        F.coalesce(one("last_update"), zero).alias("last_update_ts_ms"),
    )


def bar_detail(latest: DataFrame) -> DataFrame:
    """The newest bars with their own gaps and with timestamps, as a detail panel shows them."""
    received = F.col("received_ts_ms")
    return (
        latest.withColumn("start_ts", x.ms_to_timestamp("start_ts_ms"))
        .withColumn("end_ts", x.ms_to_timestamp("end_ts_ms"))
        .withColumn("api_gap_ms", F.when(F.col("api_send_ts_ms").isNotNull(), x.at_least_zero(received - F.col("api_send_ts_ms"))))
        .withColumn("producer_gap_ms", x.at_least_zero(received - F.col("ingest_ts_ms")))
    )


def snapshot(bars: DataFrame) -> DataFrame:
    """The columns of the aggregate table under the chart."""
    return bars.select(
        "symbol",
        x.ms_to_timestamp("start_ts_ms").alias("start_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "notional",
        "vwap",
        "bin_count",
        "max_lateness_ms",
    )


def tick_time_ms(columns: Sequence[str], now_ms: Column | None = None) -> Column:
    """Event milliseconds, else event seconds times 1000, else the API send time, else now."""
    options = {
        "event_ts_ms": lambda: F.col("event_ts_ms").cast("double"),
        "event_ts": lambda: F.col("event_ts").cast("double") * 1000.0,
        "api_send_ts_ms": lambda: F.col("api_send_ts_ms").cast("double"),
    }
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return F.coalesce(*[make() for name, make in options.items() if name in columns], now.cast("double"))


def live_rows(ticks: DataFrame, count: int = LIVE_ROWS, order: str = "arrival_seq", now_ms: Column | None = None) -> DataFrame:
    """The newest ticks as a live table shows them: numbers as fixed text, a dash where there is none."""

    def text(value: Column, digits: int) -> Column:
        return F.coalesce(x.fixed_text(x.finite(value), digits), F.lit(NO_VALUE))

    size = F.coalesce(*[F.col(c) for c in ("sz", "size") if c in ticks.columns])
    return (
        ticks.orderBy(F.col(order).desc())
        .limit(count)
        .select(
            order,
            F.coalesce("symbol", F.lit(NO_VALUE)).alias("symbol"),
            text(F.col("px"), 4).alias("px"),
            text(F.col("bid"), 4).alias("bid"),
            text(F.col("ask"), 4).alias("ask"),
            text(size, 2).alias("size"),
            tick_time_ms(ticks.columns, now_ms).alias("time_ms"),
            F.coalesce("source", F.lit(LIVE_SOURCE)).alias("source"),
        )
    )


def live_series(ticks: DataFrame, count: int = LIVE_POINTS, order: str = "arrival_seq", now_ms: Column | None = None) -> DataFrame:
    """The newest points of the price, bid and ask lines."""
    return (
        ticks.orderBy(F.col(order).desc())
        .limit(count)
        .select(
            order,
            tick_time_ms(ticks.columns, now_ms).alias("time_ms"),
            *[x.finite(c).alias(c) for c in ("px", "bid", "ask")],
        )
    )


def live_stats(ticks: DataFrame, order: str = "arrival_seq", now_ms: Column | None = None) -> DataFrame:
    """How many ticks came, and symbol, price and time of the last one."""
    last = F.max_by(
        F.struct(
            F.coalesce(x.non_blank("symbol"), F.lit(NO_VALUE)).alias("symbol"),
            F.coalesce(x.fixed_text(x.finite("px"), 4), F.lit(NO_VALUE)).alias("px"),
            tick_time_ms(ticks.columns, now_ms).alias("time_ms"),
        ),
        order,
    ).alias("last")
    return ticks.agg(F.count(F.lit(1)).alias("ticks"), last).select(
        "ticks",
        F.col("last.symbol").alias("last_symbol"),
        F.col("last.px").alias("last_price"),
        F.col("last.time_ms").alias("last_time_ms"),
    )
