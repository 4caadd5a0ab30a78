"""Turn loosely typed messages into typed ticks, and keep the usable ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.settings import DEFAULT_SYMBOL
from tickbars.sources.ticks import FILE_PLACE

# Default market opens.
OPEN_UTC = "14:30:00"
OPEN_LOCAL = "09:30"


def normalize_ticks(payloads: DataFrame, default_symbol: str = DEFAULT_SYMBOL) -> DataFrame:
    """Typed ticks; rows without a usable price or event time keep nulls there (see ``valid_ticks``).

    The source time is the millisecond field when usable, else the seconds field times 1000.
    """
    size = F.coalesce(x.finite("sz"), F.lit(0.0))
    carried = [c for c in ("arrival_seq", FILE_PLACE) if c in payloads.columns]
    return payloads.select(
        *carried,
        F.coalesce(x.non_blank("symbol"), F.lit(default_symbol)).alias("symbol"),
        x.price(x.number("px")).alias("px"),
        x.price(x.number("bid")).alias("bid"),
        x.price(x.number("ask")).alias("ask"),
        x.price(size).alias("sz"),
        x.seconds_to_ms(x.number("event_ts")).alias("event_ts_ms"),
        x.whole_ms("api_send_ts_ms").alias("api_send_ts_ms"),
        F.coalesce(x.whole_ms("source_event_ts_ms"), x.seconds_to_ms(x.number("source_event_ts"))).alias(
            "source_event_ts_ms"
        ),
        "source",
    )


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks that have a price and an event time."""
    return ticks.where(F.col("px").isNotNull() & F.col("event_ts_ms").isNotNull())


def rejected_ticks(ticks: DataFrame) -> DataFrame:
    """The complement of ``valid_ticks``."""
    return ticks.where(F.col("px").isNull() | F.col("event_ts_ms").isNull())


def only_symbols(rows: DataFrame, universe: str) -> DataFrame:
    """Rows whose symbol is in a comma-separated universe, compared trimmed and in upper case."""
    return rows.where(F.upper(F.trim("symbol")).isin(x.split_symbols(universe)))


def clock_seconds(text: str | None, default: str) -> int:
    """``HH[:MM[:SS]]`` as second of the day; anything unreadable falls back to the default."""
    for candidate in (text, default):
        try:
            parts = [int(part) for part in (candidate or "").split(":", 2)]
        except ValueError:
            continue
        hours, minutes, seconds = (parts + [0, 0])[:3]
        return hours * 3600 + minutes * 60 + seconds
    raise ValueError(f"not a clock time: {default!r}")


def _after(rows: DataFrame, when: Column, open_second: int) -> DataFrame:
    return rows.where(x.second_of_day(when) >= F.lit(open_second))


def market_open_utc(ticks: DataFrame, opens: str | None = None) -> DataFrame:
    """Ticks at or after the market open, read on the UTC clock."""
    return _after(ticks, x.ms_to_timestamp("event_ts_ms"), clock_seconds(opens, OPEN_UTC))


def market_open_local(ticks: DataFrame, zone: str, opens: str | None = None) -> DataFrame:
    """Ticks at or after the market open, read on the clock of ``zone``."""
    local = F.from_utc_timestamp(x.ms_to_timestamp("event_ts_ms"), zone)
    return _after(ticks, local, clock_seconds(opens, OPEN_LOCAL))
