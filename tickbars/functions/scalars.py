"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickbars.schemas import PRICE

# Text formats and patterns of the record contracts.
ID_FORMAT = "%s-%013d"
ID_PATTERN = "^[A-Z0-9_.-]+-[0-9]{13}$"
NOT_A_NUMBER = "[dDfFxXnN]"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def floor_ms(ts_ms: Column | str, width_ms: int) -> Column:
    """Start of the window of ``width_ms`` that holds ``ts_ms``; negative times floor downwards."""
    if isinstance(ts_ms, str):
        return F.expr(f"{ts_ms} - pmod({ts_ms}, {width_ms}L)")
    return ts_ms - F.pmod(ts_ms, F.lit(width_ms).cast("long"))


def series_id(symbol: Column | str, start_ms: Column | str, suffix: str | None = None) -> Column:
    """Deterministic key ``<symbol>-<13-digit start>[-suffix]``."""
    pattern = ID_FORMAT if suffix is None else f"{ID_FORMAT}-{suffix}"
    return F.format_string(pattern, col(symbol), col(start_ms))


def round6(value: Column) -> Column:
    """Six decimals on doubles, ties upwards on the binary value, the same on every engine."""
    return F.floor(value * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)


def price(value: Column | str) -> Column:
    """Exact six-decimal number; null when it does not fit."""
    return col(value).try_cast(PRICE)


def seconds_to_ms(seconds: Column) -> Column:
    """Epoch seconds to whole milliseconds, ties to even."""
    return F.rint(seconds * F.lit(1000.0)).try_cast("long")


def number(text: Column | str) -> Column:
    """Text to double, null for anything that is not a plain decimal number.

    The lenient cast also reads ``1d``, ``0x1p3``, ``NaN`` and ``Infinity``; the letters of those rule them out.
    """
    if isinstance(text, str):
        return F.expr(number_sql(text))
    return F.when(~text.rlike(NOT_A_NUMBER), text.try_cast("double"))


def number_sql(name: str) -> str:
    """The same as SQL text, for one column."""
    return f"CASE WHEN NOT rlike({name}, '{NOT_A_NUMBER}') THEN try_cast({name} AS DOUBLE) END"


def whole_ms(text: Column | str) -> Column:
    """Numeric text to a long, fraction cut off; null when it is not a number."""
    return number(text).try_cast("long")


def finite(value: Column | str) -> Column:
    """The number itself when finite, else null."""
    v = col(value).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def non_blank(text: Column | str) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(col(text), F.lit(""))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields null on a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


# Volume-weighted price of a folded row to six decimals; the close when nothing traded.
VWAP = (
    "coalesce(CAST(floor(CAST(notional AS DOUBLE) / nullif(CAST(volume AS DOUBLE), 0D) * 1e6D + 0.5D) AS DOUBLE) / 1e6D, "
    "CAST(close AS DOUBLE))"
)


def within(a: Column, b: Column, tolerance: float) -> Column:
    """Absolute-tolerance equality."""
    return F.abs(a - b) <= F.lit(tolerance)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast("long"))


def fixed_text(value: Column | str, digits: int) -> Column:
    """Fixed-point text of a double, rounded on its exact binary value."""
    return F.translate(F.format_number(col(value).cast("double"), digits), ",", "")


def duration_text(value_ms: Column | str) -> Column:
    """``n/a`` for null, seconds with two decimals from 1000 ms on, else whole milliseconds."""
    ms = col(value_ms).cast("double")
    return (
        F.when(ms.isNull(), F.lit("n/a"))
        .when(ms >= 1000, F.concat(fixed_text(ms / 1000.0, 2), F.lit(" s")))
        .otherwise(F.concat(fixed_text(ms, 0), F.lit(" ms")))
    )


def ms_to_timestamp(ts_ms: Column | str) -> Column:
    return F.timestamp_millis(col(ts_ms))


def timestamp_to_ms(ts: Column | str) -> Column:
    return F.unix_millis(col(ts))


def iso_weekday(ts: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(col(ts)) + F.lit(1)


def second_of_day(ts: Column | str) -> Column:
    t = col(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def split_symbols(text: str) -> list[str]:
    """``" aapl, ,msft "`` to ``["AAPL", "MSFT"]``."""
    return [part.strip().upper() for part in text.split(",") if part.strip()]
