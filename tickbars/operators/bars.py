"""Fold bins into one-second bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators.bins import wall_clock_ms
from tickbars.schemas import PRICE, WIDE
from tickbars.settings import FIVE_MINUTES_MS, SECOND_MS, UNKNOWN_SYMBOL

# Fixed value: the source tag the bar contract demands.
BAR_SOURCE = "aggregator"

GRAIN = "grain_ms"

BAR_COLUMNS = [
    "bar_id",
    "symbol",
    "start_ts_ms",
    "end_ts_ms",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "notional",
    "vwap",
    "bin_count",
    "max_lateness_ms",
    "api_send_ts_ms",
    "source_event_ts_ms",
    "ingest_ts_ms",
    "source",
]


def by_grain(rows: DataFrame, start: str = "start_ts_ms") -> DataFrame:
    """Hash rows by symbol and five-minute stretch.

    Seconds, minutes and aligned five minutes of a symbol lie inside one stretch, so all three foldings run on
    this one shuffle. A stretch holds at most one row per symbol and grid step, so no task can be flooded.
    """
    return rows.withColumn(GRAIN, x.floor_ms(start, FIVE_MINUTES_MS)).repartition("symbol", GRAIN)


def fold_bins(
    bins: DataFrame,
    lateness: Column | None = None,
    ingest: Column | None = None,
    order: str = "start_ts_ms",
    keep_grain: bool = False,
) -> DataFrame:
    """One bar per symbol and second.

    ``lateness`` is the bins' own lateness on arrival; bins straight from the fold come in order and have none.
    """
    late = F.lit(0).cast("long") if lateness is None else lateness
    second = x.floor_ms("start_ts_ms", SECOND_MS)
    folded = (
        by_grain(bins.withColumn("_late", late))
        .groupBy("symbol", GRAIN, second.alias("bar_start"))
        .agg(
            F.expr(f"min_by(open, {order}) AS open"),
            F.expr("max(high) AS high"),
            F.expr("min(low) AS low"),
            F.expr(f"max_by(close, {order}) AS close"),
            F.expr("CAST(sum(volume) AS DECIMAL(38,6)) AS volume"),
            F.expr("CAST(sum(notional) AS DECIMAL(38,6)) AS notional"),
            F.expr("count(1) AS bin_count"),
            F.expr("max(_late) AS max_lateness_ms"),
            F.expr("min(api_send_ts_ms) AS api_send_ts_ms"),
            F.expr("min(source_event_ts_ms) AS source_event_ts_ms"),
        )
    )
    return finish_bars(folded, ingest, keep_grain)


def finish_bars(folded: DataFrame, ingest: Column | None = None, keep_grain: bool = False) -> DataFrame:
    """Add id, end, VWAP, emission time and source to folded bars."""
    extra = [GRAIN] if keep_grain else []
    identified = folded.selectExpr(
        f"format_string('{x.ID_FORMAT}', symbol, bar_start) AS bar_id",
        "bar_start AS start_ts_ms",
        f"bar_start + {SECOND_MS} AS end_ts_ms",
        f"{x.VWAP} AS vwap",
        f"'{BAR_SOURCE}' AS source",
        "*",
    )
    emitted = wall_clock_ms() if ingest is None else ingest
    return identified.withColumn("ingest_ts_ms", emitted).select(*BAR_COLUMNS, *extra)


def expected_bars(log: DataFrame, order: str = "start_ts_ms") -> DataFrame:
    """Bars rebuilt in batch from a bin log, with the fallbacks for thin records, to check a run against.

    A record may carry ``price`` and ``sz`` instead of the bin fields; its notional defaults to close times
    volume. Lateness is the one written in the log, and the VWAP comes from the rounded sums.
    """
    have = set(log.columns)

    def field(*names: str, default: float = 0.0) -> Column:
        return F.coalesce(*[F.col(n) for n in names if n in have], F.lit(default).cast(PRICE))

    opened = field("open", "price")
    filled = (
        log.withColumn("symbol", F.coalesce(x.non_blank("symbol"), F.lit(UNKNOWN_SYMBOL)))
        .withColumn("start_ts_ms", F.coalesce("start_ts_ms", F.lit(0).cast("long")))
        .withColumn("_open", opened.cast(PRICE))
        .withColumn("_high", (F.coalesce("high", "_open") if "high" in have else F.col("_open")).cast(PRICE))
        .withColumn("_low", (F.coalesce("low", "_open") if "low" in have else F.col("_open")).cast(PRICE))
        .withColumn("_close", (F.coalesce("close", "_open") if "close" in have else F.col("_open")).cast(PRICE))
        .withColumn("_volume", field("volume", "sz").cast(WIDE))
        .withColumn("_traded", (F.col("_close") * F.col("_volume")).cast(WIDE))
        .withColumn("_notional", (F.coalesce("notional", "_traded") if "notional" in have else F.col("_traded")))
        .withColumn("_late", F.coalesce("max_lateness_ms", F.lit(0).cast("long")))
    )
    folded = filled.groupBy("symbol", x.floor_ms("start_ts_ms", SECOND_MS).alias("bar_start")).agg(
        F.min_by("_open", order).alias("open"),
        F.max("_high").alias("high"),
        F.min("_low").alias("low"),
        F.max_by("_close", order).alias("close"),
        F.sum("_volume").cast(WIDE).alias("volume"),
        F.sum("_notional").cast(WIDE).alias("notional"),
        F.count(F.lit(1)).alias("bin_count"),
        F.max("_late").alias("max_lateness_ms"),
    )
    return folded.selectExpr(
        f"format_string('{x.ID_FORMAT}', symbol, bar_start) AS bar_id",
        "symbol",
        "bar_start AS start_ts_ms",
        f"bar_start + {SECOND_MS} AS end_ts_ms",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "notional",
        f"{x.VWAP} AS vwap",
        "bin_count",
        "max_lateness_ms",
    )


def last_per_key(rows: DataFrame, key: str = "bar_id", order: str = "arrival_seq") -> DataFrame:
    """The last delivered row of each key.

    An aggregate, not a window: copies of one key combine on the map side, so a key with very many copies does
    not land in one task. Rows without a key are left out (see ``without_key``).
    """
    body = [c for c in rows.columns if c not in (key, order)]
    newest = F.max_by(F.struct(*body), order).alias("_row")
    kept = rows.where(F.col(key).isNotNull()).groupBy(key).agg(newest, F.max(order).alias(order))
    return kept.select(*[F.col(c) if c in (key, order) else F.col(f"_row.{c}") for c in rows.columns])


def without_key(rows: DataFrame, key: str = "bar_id") -> DataFrame:
    """Rows that carry no key and therefore cannot be matched or upserted."""
    return rows.where(F.col(key).isNull())
