"""Typed fact rows: exact decimals, UTC timestamps, load time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators.bins import wall_clock_ms
from tickbars.schemas import FACT_1S, FACT_60S, FACT_300S, PRICE


# The decimal columns of the fact tables.
DECIMALS = ("open", "high", "low", "close", "volume", "notional", "vwap")


def _loose(name: str) -> str:
    """Number of a loosely typed field: booleans count as 1 and 0, blanks and other text as missing."""
    flag = f"CASE lower({name}) WHEN 'true' THEN 1D WHEN 'false' THEN 0D END"
    return f"coalesce({x.number_sql(name)}, {flag}) AS {name}"


def _load_ts(load_ts: Column | dt.datetime | None) -> Column:
    return F.current_timestamp() if load_ts is None else F.lit(load_ts)


def bars_from_records(records: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Loose one-second records as bars. Records without key, symbol or non-zero times are left out."""
    now = wall_clock_ms() if now_ms is None else now_ms
    whole = ("start_ts_ms", "end_ts_ms", "ingest_ts_ms", "bin_count", "max_lateness_ms")
    real = ("open", "high", "low", "close", "volume", "notional", "vwap")
    keyed = records.where("bar_id IS NOT NULL AND symbol IS NOT NULL")
    texts = keyed.selectExpr("bar_id", "symbol", *[f"CAST({name} AS STRING) AS {name}" for name in (*whole, *real)])
    numbers = texts.selectExpr("bar_id", "symbol", *[_loose(name) for name in (*whole, *real)]).withColumn("_now", now)
    coerced = numbers.selectExpr(
        "bar_id",
        "symbol",
        "try_cast(start_ts_ms AS BIGINT) AS start_ts_ms",
        "try_cast(end_ts_ms AS BIGINT) AS end_ts_ms",
        "coalesce(nullif(try_cast(ingest_ts_ms AS BIGINT), 0L), _now) AS ingest_ts_ms",
        "coalesce(open, 0D) AS open",
        "coalesce(high, open, 0D) AS high",
        "coalesce(low, open, 0D) AS low",
        "coalesce(close, open, 0D) AS close",
        "coalesce(volume, 0D) AS volume",
        "coalesce(notional, 0D) AS notional",
        "coalesce(vwap, close, open, 0D) AS vwap",
        "coalesce(try_cast(bin_count AS BIGINT), 0L) AS bin_count",
        "coalesce(try_cast(max_lateness_ms AS BIGINT), 0L) AS max_lateness_ms",
    )
    return coerced.where("start_ts_ms <> 0 AND end_ts_ms <> 0")


def fact_1s_from_records(records: DataFrame, now_ms: Column | None = None, load_ts: Column | dt.datetime | None = None) -> DataFrame:
    """Loose one-second records to typed rows."""
    return fact_1s(bars_from_records(records, now_ms), load_ts)


def _misfits(rows: DataFrame) -> Column:
    """Names of the numbers of a row that the fact decimals can't hold, as one array."""
    lost = [
        F.when(F.col(n).isNotNull() & F.col(n).try_cast(PRICE).isNull(), F.lit(n)) for n in DECIMALS if n in rows.columns
    ]
    return F.array_compact(F.array(*lost))


def split_by_fit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose numbers fit the fact decimals, and the rows that would overflow, with the names of those numbers."""
    marked = rows.withColumn("misfits", _misfits(rows))
    return marked.where(F.size("misfits") == 0).drop("misfits"), marked.where(F.size("misfits") > 0)


def rejects(bars: DataFrame) -> DataFrame:
    """Bars of any width left out of the facts: key, start, the misfits, and their values as text."""
    lost = split_by_fit(bars)[1]
    values = F.to_json(F.struct(*[F.col(n).cast("string").alias(n) for n in DECIMALS if n in bars.columns]))
    return lost.select("bar_id", "symbol", "start_ts_ms", "misfits", values.alias("numbers"))


def _typed(bars: DataFrame, schema, load_ts: Column | dt.datetime | None) -> DataFrame:
    """The bars that fit, in the table's types; ``rejects`` has the others."""
    rows = (
        split_by_fit(bars)[0]
        .withColumn("start_ts", x.ms_to_timestamp("start_ts_ms"))
        .withColumn("end_ts", x.ms_to_timestamp("end_ts_ms"))
        .withColumn("ingest_ts", x.ms_to_timestamp("ingest_ts_ms"))
        .withColumn("load_ts", _load_ts(load_ts))
    )
    return rows.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])


def fact_1s(bars: DataFrame, load_ts: Column | dt.datetime | None = None) -> DataFrame:
    return _typed(bars, FACT_1S, load_ts)


def fact_60s(minutes: DataFrame, load_ts: Column | dt.datetime | None = None) -> DataFrame:
    """Minute bars (with or without ``minute_index``) to rows of the minute fact table."""
    rows = minutes if "minute_index" in minutes.columns else minutes.withColumn("minute_index", F.lit(None))
    return _typed(rows, FACT_60S, load_ts)


def fact_300s(five_minutes: DataFrame, load_ts: Column | dt.datetime | None = None) -> DataFrame:
    return _typed(five_minutes, FACT_300S, load_ts)


def with_trade_hour(facts: DataFrame) -> DataFrame:
    """Add the partition columns of the stored facts: the day, and the hour of it."""
    return facts.withColumn("trade_date", F.to_date("start_ts")).withColumn("trade_hour", F.hour("start_ts"))
