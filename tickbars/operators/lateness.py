"""Per-symbol event-time watermarks, lateness, and the split into accepted and late rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.operators import ordering
from tickbars.settings import MAX_LATE_MS

# Reasons written to the dead-letter output.
LATE_TICK = "late_tick"
LATE_BIN = "late_bin"


def with_lateness(
    rows: DataFrame,
    order: str,
    time: str,
    chunk: Column | None = None,
    watermark: str | None = None,
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``lateness_ms``: how far a row lies behind the newest time its symbol showed in earlier arrivals.

    The arrival order is cut into chunks (even ones, or by ``chunk``), and the running maximum of a chunk is carried
    into the later ones. ``watermark`` names a column that holds the symbol's watermark from before this input, as
    in micro-batches.
    """
    if chunk is None:
        chunked = ordering.with_even_chunk(rows, order, rows_per_chunk)
    else:
        chunked = rows.withColumn(ordering.CHUNK, chunk)
    rows = ordering.carry(
        chunked,
        ["symbol"],
        ordering.CHUNK,
        [F.max(time).alias("_top")],
        lambda over: [F.max("_top").over(over.rowsBetween(W.unboundedPreceding, -1)).alias("_carried")],
    )
    floors = [F.lit(0).cast("long"), F.col("_carried"), *([] if watermark is None else [F.col(watermark)])]
    inside = W.partitionBy("symbol", ordering.CHUNK).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    late = F.greatest(F.greatest(F.max(time).over(inside), *floors) - F.col(time), F.lit(0).cast("long"))
    return rows.withColumn("lateness_ms", late).drop(ordering.CHUNK, "_carried")


def accepted(rows: DataFrame, max_late_ms: int = MAX_LATE_MS) -> DataFrame:
    """Rows no more than ``max_late_ms`` behind the watermark."""
    return rows.where(F.col("lateness_ms") <= max_late_ms)


def late(rows: DataFrame, max_late_ms: int = MAX_LATE_MS) -> DataFrame:
    """Rows beyond the allowed lateness."""
    return rows.where(F.col("lateness_ms") > max_late_ms)


def late_tick_letters(classified: DataFrame, max_late_ms: int = MAX_LATE_MS) -> DataFrame:
    """Dead letters for late ticks, with the tick as it came."""
    body = [c for c in classified.columns if c != "lateness_ms"]
    return late(classified, max_late_ms).select(
        F.lit(LATE_TICK).alias("reason"),
        "lateness_ms",
        "symbol",
        "event_ts_ms",
        F.struct(*body).alias("tick"),
    )


def late_bin_letters(classified: DataFrame, max_late_ms: int = MAX_LATE_MS) -> DataFrame:
    """Dead letters for late bins, with the bin as it came."""
    body = [c for c in classified.columns if c != "lateness_ms"]
    return late(classified, max_late_ms).select(
        F.lit(LATE_BIN).alias("reason"),
        "lateness_ms",
        "symbol",
        "start_ts_ms",
        "end_ts_ms",
        F.struct(*body).alias("payload"),
    )


def late_counts(letters: DataFrame) -> DataFrame:
    """Dead-letter volume by symbol and reason."""
    return letters.groupBy("symbol", "reason").agg(
        F.count(F.lit(1)).alias("late_rows"), F.max("lateness_ms").alias("worst_lateness_ms")
    )
