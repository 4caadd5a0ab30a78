"""Record layouts, written out by hand; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 6)
#: Sums until they are typed as facts: wide enough that no input overflows them.
WIDE = T.DecimalType(38, 6)


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "PRICE": PRICE,
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
}


def _struct(spec: str) -> T.StructType:
    """``"name TYPE, name TYPE"`` to a struct; needs no running session."""
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


EVENTS = _struct("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")

TICK_CSV = _struct("trade_day STRING, trade_time STRING, price STRING, bid STRING, ask STRING, size STRING, _bad STRING")

# As delivered: numbers may arrive as JSON strings, so the lenient fields stay text until normalised. A size
# counts only when it is a JSON number, so it is typed here and a string becomes null.
TICK_JSON = _struct(
    "symbol STRING, px STRING, bid STRING, ask STRING, sz DOUBLE, event_ts STRING, "
    "api_send_ts_ms STRING, source STRING, source_event_ts STRING, source_event_ts_ms STRING"
)

TICK = _struct(
    "arrival_seq BIGINT, symbol STRING, px DOUBLE, bid DOUBLE, ask DOUBLE, sz DOUBLE, event_ts DOUBLE, "
    "api_send_ts_ms BIGINT, source STRING, source_event_ts DOUBLE, source_event_ts_ms BIGINT"
)

BIN = _struct(
    "bin_id STRING, symbol STRING, start_ts_ms BIGINT, end_ts_ms BIGINT, window_ms INT, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume DOUBLE, notional DOUBLE, trade_count INT, max_lateness_ms BIGINT, "
    "api_send_ts_ms BIGINT, source_event_ts_ms BIGINT, ingest_ts_ms BIGINT, source STRING"
)

BAR_1S = _struct(
    "bar_id STRING, symbol STRING, start_ts_ms BIGINT, end_ts_ms BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, "
    "close DOUBLE, volume DOUBLE, notional DOUBLE, vwap DOUBLE, bin_count INT, max_lateness_ms BIGINT, "
    "api_send_ts_ms BIGINT, source_event_ts_ms BIGINT, ingest_ts_ms BIGINT, source STRING"
)

QUOTE = _struct(
    "symbol STRING, last_price DOUBLE, bid DOUBLE, ask DOUBLE, last_size DOUBLE, bid_size DOUBLE, ask_size DOUBLE, quote_ts_ms BIGINT"
)

_OHLC_OPEN_FIRST = "open PRICE, high PRICE, low PRICE, close PRICE"
_OHLC_CLOSE_SECOND = "open PRICE, close PRICE, high PRICE, low PRICE"

FACT_1S = _struct(
    f"bar_id STRING, symbol STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, {_OHLC_OPEN_FIRST}, volume PRICE, "
    "notional PRICE, vwap PRICE, bin_count INT, max_lateness_ms INT, ingest_ts TIMESTAMP, load_ts TIMESTAMP"
)

FACT_60S = _struct(
    f"bar_id STRING, symbol STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, {_OHLC_CLOSE_SECOND}, volume PRICE, "
    "notional PRICE, ingest_ts TIMESTAMP, source_count INT, minute_index INT, load_ts TIMESTAMP"
)

FACT_300S = _struct(
    f"bar_id STRING, symbol STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, {_OHLC_CLOSE_SECOND}, volume PRICE, "
    "notional PRICE, ingest_ts TIMESTAMP, minute_count INT, source_count INT, load_ts TIMESTAMP"
)

DIM_SYMBOL = _struct(
    "symbol STRING, name STRING, exchange STRING, sector STRING, industry STRING, is_active BOOLEAN, load_ts TIMESTAMP"
)

DIM_CALENDAR = _struct(
    "calendar_minute TIMESTAMP, trade_date DATE, weekday INT, hour INT, minute INT, is_trading_session BOOLEAN, "
    "session_name STRING, load_ts TIMESTAMP"
)
