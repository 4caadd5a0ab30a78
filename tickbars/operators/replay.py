"""Steps of a tick replay as table operators: rebasing, pacing, and cutting out a part of the history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.operators import ordering

# Default pacing.
SPEED = 1.0
MAX_SLEEP_S = 1.0


def rebase(ticks: DataFrame, anchor_ms: int, order: str = "arrival_seq") -> DataFrame:
    """Shift all event times so that the first arrived row falls on ``anchor_ms``; keep the original as source time.

    The first row's time is a scalar subquery, not a join.
    """
    first = ticks.agg(F.min_by("event_ts_ms", order)).scalar()
    return ticks.withColumn("source_event_ts_ms", F.col("event_ts_ms")).withColumn(
        "event_ts_ms", F.col("event_ts_ms") + (F.lit(anchor_ms).cast("long") - first)
    )


def schedule(
    ticks: DataFrame,
    speed: float = SPEED,
    max_sleep_s: float = MAX_SLEEP_S,
    order: str = "arrival_seq",
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
) -> DataFrame:
    """Planned emission offset of each tick in microseconds since its symbol's first one.

    The pause before a tick is the step in event time (never negative) divided by ``speed`` and, unless
    ``max_sleep_s`` is negative, capped. The arrival order is cut into even chunks; both the previous time and the
    running sum are carried across their borders.
    """
    if speed <= 0:
        raise ValueError("speed must be positive")
    keys = ["symbol"]
    rows = ordering.with_even_chunk(ticks, order, rows_per_chunk)
    over = W.partitionBy(*keys, ordering.CHUNK).orderBy(order)
    rows = ordering.carry(
        rows,
        keys,
        ordering.CHUNK,
        [F.max_by("event_ts_ms", order).alias("_last")],
        lambda chunks: [F.lag("_last").over(chunks).alias("_previous")],
    )
    previous = F.coalesce(F.lag("event_ts_ms").over(over), F.col("_previous"))
    step = F.greatest(F.coalesce(F.col("event_ts_ms") - previous, F.lit(0)), F.lit(0))
    pause = F.rint(step * F.lit(1000.0) / F.lit(speed)).cast("long")
    if max_sleep_s >= 0:
        pause = F.least(pause, F.lit(round(max_sleep_s * 1_000_000)).cast("long"))
    rows = ordering.carry(
        rows.withColumn("pause_us", pause).drop("_previous"),
        keys,
        ordering.CHUNK,
        [F.sum("pause_us").alias("_sum")],
        lambda chunks: [F.sum("_sum").over(chunks.rowsBetween(W.unboundedPreceding, -1)).alias("_before")],
    )
    total = F.sum("pause_us").over(over.rowsBetween(W.unboundedPreceding, W.currentRow))
    total = total + F.coalesce("_before", F.lit(0))
    return rows.withColumn("emit_offset_us", total).drop(ordering.CHUNK, "_before")


def first_n(rows: DataFrame, count: int, order: str = "arrival_seq") -> DataFrame:
    """The first ``count`` rows in arrival order."""
    if count <= 0:
        raise ValueError("count must be positive")
    return rows.orderBy(order).limit(count)


def distinct_dates(rows: DataFrame, ts: str) -> DataFrame:
    """The dates that occur, one row each."""
    return rows.select(F.to_date(ts).alias("day")).distinct()


def first_full_week(rows: DataFrame, ts: str) -> DataFrame:
    """The rows of the first Monday-to-Friday week of which all five days occur; an error when there is none."""
    days = distinct_dates(rows, ts).where(F.weekday("day") <= 4)
    weeks = (
        days.groupBy(F.trunc("day", "week").alias("monday"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 5)
        .agg(F.min("monday").alias("monday"))
    )
    none = F.raise_error(F.lit("no complete Monday-Friday week in the data")).cast("date")
    monday = weeks.select(F.coalesce("monday", none)).scalar()
    return rows.where(F.to_date(ts).between(monday, F.date_add(monday, 4)))
