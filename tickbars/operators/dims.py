"""Symbol and calendar dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.schemas import DIM_CALENDAR, DIM_SYMBOL

# The seed rows of the symbol dimension.
SYMBOL_SEED = [
    ("WDC", "Western Digital Corporation", "NASDAQ", "Technology", "Computer Hardware"),
    ("AAPL", "Apple Inc.", "NASDAQ", "Technology", "Consumer Electronics"),
    ("MSFT", "Microsoft Corporation", "NASDAQ", "Technology", "Software"),
    ("TSLA", "Tesla Inc.", "NASDAQ", "Consumer Discretionary", "Automobiles"),
]

# The regular session in UTC, Monday to Friday, and its labels.
SESSION_FIRST_MINUTE = 13 * 60 + 30
SESSION_LAST_MINUTE = 19 * 60 + 59
REGULAR = "REG"
CLOSED = "OFF"


def dim_symbol(spark: SparkSession, load_ts: Column | dt.datetime | None = None) -> DataFrame:
    """The seeded symbol dimension."""
    seed = spark.createDataFrame(SYMBOL_SEED, "symbol STRING, name STRING, exchange STRING, sector STRING, industry STRING")
    stamped = seed.withColumn("is_active", F.lit(True)).withColumn(
        "load_ts", F.current_timestamp() if load_ts is None else F.lit(load_ts)
    )
    return stamped.select(*[F.col(f.name).cast(f.dataType) for f in DIM_SYMBOL.fields])


def in_session(minute: Column | str) -> Column:
    """Whether a UTC minute lies in the regular session."""
    when = x.col(minute)
    of_day = F.hour(when) * 60 + F.minute(when)
    return (x.iso_weekday(when) <= 5) & of_day.between(SESSION_FIRST_MINUTE, SESSION_LAST_MINUTE)


def _describe(minutes: DataFrame, load_ts: Column | dt.datetime | None) -> DataFrame:
    when = F.col("calendar_minute")
    rows = (
        minutes.withColumn("trade_date", F.to_date(when))
        .withColumn("weekday", x.iso_weekday(when))
        .withColumn("hour", F.hour(when))
        .withColumn("minute", F.minute(when))
        .withColumn("is_trading_session", in_session(when))
        .withColumn("session_name", F.when(in_session(when), REGULAR).otherwise(CLOSED))
        .withColumn("load_ts", F.current_timestamp() if load_ts is None else F.lit(load_ts))
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in DIM_CALENDAR.fields])


def dim_calendar(
    spark: SparkSession, first: dt.date = dt.date(2025, 1, 1), last: dt.date = dt.date(2025, 12, 31), load_ts: Column | dt.datetime | None = None
) -> DataFrame:
    """One row per minute of the days ``first`` to ``last``, both included."""
    minutes = ((last - first).days + 1) * 1440
    if minutes <= 0:
        raise ValueError("the calendar must span at least one day")
    start = int(dt.datetime(first.year, first.month, first.day, tzinfo=dt.timezone.utc).timestamp())
    ticks = spark.range(minutes).select(F.timestamp_seconds(F.col("id") * 60 + start).alias("calendar_minute"))
    return _describe(ticks, load_ts)


def calendar_of(rows: DataFrame, ts: str, load_ts: Column | dt.datetime | None = None) -> DataFrame:
    """The calendar of all days that ``rows`` touch, from the first to the last, without gaps."""
    span = rows.agg(F.min(F.to_date(ts)).alias("first"), F.max(F.to_date(ts)).alias("last"))
    # A row per day at first; the days are spread before they become minutes.
    days = span.select(F.explode(F.sequence("first", "last")).alias("day")).repartition("day")
    minute = F.explode(F.sequence(F.lit(0), F.lit(1439)))
    minutes = days.select("day", minute.alias("m")).select(
        (F.col("day").cast("timestamp") + F.make_dt_interval(mins=F.col("m"))).alias("calendar_minute")
    )
    return _describe(minutes, load_ts)


def with_session(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add session flag and label of each bar's first minute.

    The calendar joins by equality on the minute; Spark broadcasts it when its size allows and shuffles otherwise.
    """
    lookup = calendar.select("calendar_minute", "is_trading_session", "session_name")
    at = F.date_trunc("minute", bars["start_ts"])
    return bars.join(lookup, at == lookup["calendar_minute"], "left").drop("calendar_minute")


def with_symbol_details(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """Left-join the symbol dimension; rows of unknown symbols stay, with nulls.

    No broadcast is forced: Spark broadcasts the dimension while it is small and splits a skewed symbol otherwise.
    """
    return rows.join(symbols, "symbol", "left")
