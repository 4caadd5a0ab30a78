"""The reporting views over the fact tables, as functions and as registered views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions import scalars as x
from tickbars.operators import dims, ordering
from tickbars.sinks import versioned

# Rows of the rolling window, and the look-back of the movers report.
ROLLING_ROWS = 60
MOVERS_MINUTES = 15

_MICRO = "decimal(19,0)"


def pipeline_minute_metrics(facts_60s: DataFrame) -> DataFrame:
    """Ingestion statistics per symbol and minute of the bars' end."""
    return facts_60s.groupBy("symbol", F.date_trunc("minute", "end_ts").alias("minute_ts")).agg(
        F.count(F.lit(1)).alias("bars_in_batch"),
        F.max("ingest_ts").alias("last_ingest_ts"),
        F.max("end_ts").alias("last_bar_end_ts"),
        (F.unix_millis(F.max("ingest_ts")) - F.unix_millis(F.max("end_ts"))).alias("latency_ms"),
        F.sum("volume").alias("volume_1m"),
        F.sum("notional").alias("notional_1m"),
    )


def pipeline_5m(facts_300s: DataFrame) -> DataFrame:
    """Narrow projection of the five-minute facts; only these columns are read from storage."""
    return facts_300s.select(
        "symbol", "start_ts", "end_ts", "minute_count", "source_count", "volume", "notional", "ingest_ts"
    )


def price_60s(facts_60s: DataFrame, symbols: DataFrame) -> DataFrame:
    """Minute prices with company details."""
    details = symbols.select("symbol", F.col("name").alias("company_name"), "exchange", "sector", "industry")
    facts = facts_60s.select(
        "symbol", "start_ts", "end_ts", "open", "high", "low", "close", "volume", "notional", "ingest_ts"
    )
    return dims.with_symbol_details(facts, details)


def session_vwap(facts_60s: DataFrame) -> DataFrame:
    """Volume-weighted price and volume per symbol and day; null price when nothing traded."""
    return facts_60s.groupBy("symbol", F.date_trunc("day", "start_ts").alias("trade_date")).agg(
        x.ratio(F.sum("notional"), F.sum("volume")).alias("session_vwap"),
        F.sum("volume").alias("session_volume"),
    )


def top_movers(facts_300s: DataFrame, as_of: dt.datetime | Column | None = None, limit: int | None = None) -> DataFrame:
    """Symbols by price change over the last fifteen minutes before ``as_of`` (UTC), largest first.

    The change is highest close over lowest open. With ``limit`` only the top rows are kept (a top-k report). The
    end filter reaches the scan; the start day is no bound, since a bar built by count may span days.
    """
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    since = now - F.expr(f"INTERVAL {MOVERS_MINUTES} MINUTES")
    recent = facts_300s.where(F.col("end_ts") >= since)
    opened = F.min("open")
    movers = recent.groupBy("symbol").agg(
        F.max("end_ts").alias("last_bar_end"),
        x.ratio(F.max("close") - opened, opened).alias("pct_change"),
        F.sum("volume").alias("total_volume"),
    )
    ranked = movers.orderBy(F.col("pct_change").desc(), "symbol")
    return ranked if limit is None else ranked.limit(limit)


def stored_top_movers(spark: SparkSession, path: str, schema: T.StructType, as_of: dt.datetime, limit: int | None = None) -> DataFrame:
    """``top_movers`` over the versioned five-minute facts at ``path``, opening only files with bars that end late enough."""
    since = as_of - dt.timedelta(minutes=MOVERS_MINUTES)
    return top_movers(versioned.recent(spark, path, schema, since), as_of, limit)


def _with_ordinal(facts_60s: DataFrame) -> DataFrame:
    return ordering.with_ordinal(facts_60s, ["symbol"], F.to_date("start_ts"), "start_ts", "_ordinal")


def _rolling(facts_60s: DataFrame, with_vwap: bool) -> DataFrame:
    """Trailing mean, sample deviation and, if asked, VWAP over the last 60 bars of each symbol.

    All sums are exact: prices count in millionths, and the variance numerator ``n*S2 - S1*S1`` is an integer, so
    nothing cancels and the result does not depend on how rows were distributed.
    """
    micro = (F.col("close") * F.lit(1_000_000)).cast(_MICRO)
    sums = {"_s1": micro, "_s2": micro * micro}
    if with_vwap:
        sums |= {"_n": F.col("notional"), "_v": F.col("volume")}
    kept = ["symbol", "start_ts", "close"] + (["notional", "volume"] if with_vwap else [])
    rows = _with_ordinal(facts_60s.select(*kept))
    summed = ordering.rolling_sums(rows, ["symbol"], "_ordinal", ROLLING_ROWS, sums)
    n = F.least(F.col("_ordinal"), F.lit(ROLLING_ROWS))
    spread = (n.cast("decimal(4,0)") * F.col("_s2") - F.col("_s1").cast(_MICRO) * F.col("_s1").cast(_MICRO)).cast("double")
    deviation = F.sqrt(spread / (n * (n - 1)).cast("double")) / F.lit(1e6)
    out = [
        "symbol",
        "start_ts",
        "close",
        (F.col("_s1").cast("double") / n.cast("double") / F.lit(1e6)).alias("ma_60"),
        F.when(n > 1, deviation).alias("std_60"),
    ]
    if with_vwap:
        out.append(x.ratio(F.col("_n"), F.col("_v")).alias("rolling_vwap"))
    return summed.select(*out)


def volatility_bands(facts_60s: DataFrame) -> DataFrame:
    """Trailing mean and sample standard deviation of the close; the deviation of one bar is null."""
    return _rolling(facts_60s, with_vwap=False)


def price_60s_features(facts_60s: DataFrame) -> DataFrame:
    """Trailing mean, deviation and VWAP of the minute bars."""
    return _rolling(facts_60s, with_vwap=True)


def register_views(
    spark: SparkSession, facts_60s: DataFrame, facts_300s: DataFrame, symbols: DataFrame, as_of: dt.datetime | None = None
) -> list[str]:
    """Register every view under its name so that plain SQL can read it."""
    views = {
        "vw_pipeline_minute_metrics": pipeline_minute_metrics(facts_60s),
        "vw_pipeline_5m": pipeline_5m(facts_300s),
        "vw_price_60s": price_60s(facts_60s, symbols),
        "vw_price_60s_features": price_60s_features(facts_60s),
        "vw_volatility_bands": volatility_bands(facts_60s),
        "vw_session_vwap": session_vwap(facts_60s),
        "vw_top_movers_15m": top_movers(facts_300s, as_of),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)
