"""Fill the empty bins between a symbol's first and last bin with flat, zero-volume ones.

Filler between two bins is one run of equal rows, so it is kept as a run ``[first, last]`` with a count and
cut only where a larger window begins. One row then stands for up to a whole window of bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators import bars as bar_ops
from tickbars.operators import ordering
from tickbars.operators.bins import BIN_COLUMNS, BIN_SOURCE
from tickbars.schemas import WIDE
from tickbars.settings import BIN_MS, HOUR_MS, SECOND_MS


def with_next_start(bins: DataFrame) -> DataFrame:
    """Add the start of the symbol's next bin, in one pass over the bins.

    Inside an hour it is the next row. The first and last bins of the hours, two rows an hour, then stand beside each
    other in a group of their own, where the last of an hour finds the first of the next.
    """
    hour = x.floor_ms("start_ts_ms", HOUR_MS)
    inside = W.partitionBy("symbol", ordering.CHUNK).orderBy("start_ts_ms")
    rows = bins.withColumn(ordering.CHUNK, hour).select(
        "*", F.lead("start_ts_ms").over(inside).alias("_next"), F.lag("start_ts_ms").over(inside).alias("_before")
    )
    border = F.col("_next").isNull() | F.col("_before").isNull()
    rows = rows.withColumn(ordering.CHUNK, F.when(~border, F.col(ordering.CHUNK)))
    following = F.coalesce("_next", F.lead("start_ts_ms").over(inside))
    return rows.withColumn("next_start_ms", following).drop(ordering.CHUNK, "_next", "_before")


def _runs(bins: DataFrame, bin_ms: int) -> DataFrame:
    """The stretches without bins: symbol, carried close, first and end of the stretch."""
    gaps = with_next_start(bins.select("symbol", "start_ts_ms", "close"))
    return gaps.where(f"next_start_ms > start_ts_ms + {bin_ms}").selectExpr(
        "symbol", "close AS price", f"start_ts_ms + {bin_ms} AS run_start", "next_start_ms AS run_end"
    )


def _cut(runs: DataFrame, width_ms: int) -> DataFrame:
    """Cut runs where windows of ``width_ms`` begin."""
    first = f"run_start - pmod(run_start, {width_ms}L)"
    last = f"run_end - 1 - pmod(run_end - 1, {width_ms}L)"
    return runs.selectExpr("*", f"explode(sequence({first}, {last}, {width_ms}L)) AS _w").selectExpr(
        "symbol",
        "price",
        "greatest(run_start, _w) AS run_start",
        f"least(run_end, _w + {width_ms}) AS run_end",
    )


def filler_runs(bins: DataFrame, window_ms: int, bin_ms: int = BIN_MS) -> DataFrame:
    """Runs of filler bins, none crossing a window of ``window_ms``: first and last start, and the count.

    Runs are cut by hour before they are cut finer, and spread in between, so a symbol that was silent for a
    year costs neither a huge array nor one busy task.
    """
    hours = _cut(_runs(bins, bin_ms), HOUR_MS)
    pieces = _cut(hours.repartition("symbol", x.floor_ms("run_start", HOUR_MS)), window_ms)
    placed = pieces.selectExpr(
        "symbol",
        "price",
        f"run_start + pmod(-run_start, {bin_ms}L) AS first_ms",
        f"run_end + pmod(-run_end, {bin_ms}L) - {bin_ms} AS last_ms",
    )
    return placed.where("last_ms >= first_ms").selectExpr("*", f"(last_ms - first_ms) div {bin_ms} + 1 AS bin_count")


def real_pieces(bins: DataFrame) -> DataFrame:
    """Bins in the layout of pieces: a run of one."""
    return bins.selectExpr(
        "symbol",
        "start_ts_ms AS first_ms",
        "start_ts_ms AS last_ms",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "notional",
        "1L AS bin_count",
        "api_send_ts_ms",
        "source_event_ts_ms",
    )


def filler_pieces(bins: DataFrame, window_ms: int, bin_ms: int = BIN_MS) -> DataFrame:
    """Filler runs in the layout of pieces: flat at the carried close, nothing traded."""
    return filler_runs(bins, window_ms, bin_ms).selectExpr(
        "symbol",
        "first_ms",
        "last_ms",
        "price AS open",
        "price AS high",
        "price AS low",
        "price AS close",
        "CAST(0 AS DECIMAL(38,6)) AS volume",
        "CAST(0 AS DECIMAL(38,6)) AS notional",
        "bin_count",
        "CAST(NULL AS BIGINT) AS api_send_ts_ms",
        "CAST(NULL AS BIGINT) AS source_event_ts_ms",
    )


_PIECE = (
    "symbol, run_start, run_end, open, high, low, close, volume, notional, api_send_ts_ms, source_event_ts_ms, filler"
).split(", ")


def pieces(bins: DataFrame, window_ms: int, bin_ms: int = BIN_MS) -> DataFrame:
    """Real bins and filler runs in one layout, ready to be folded by windows of ``window_ms``.

    The bins are read once: each row gives itself and, if a gap follows, the filler run after it. Runs are cut by hour
    and spread before they are cut finer, as in ``filler_runs``.
    """
    real = (
        f"named_struct('run_start', start_ts_ms, 'run_end', start_ts_ms + {bin_ms}, 'open', open, 'high', high, 'low', low, "
        "'close', close, 'volume', volume, 'notional', notional, 'api_send_ts_ms', api_send_ts_ms, "
        "'source_event_ts_ms', source_event_ts_ms, 'filler', false)"
    )
    flat = (
        f"named_struct('run_start', start_ts_ms + {bin_ms}, 'run_end', next_start_ms, 'open', close, 'high', close, "
        "'low', close, 'close', close, 'volume', CAST(0 AS DECIMAL(38,6)), 'notional', CAST(0 AS DECIMAL(38,6)), "
        "'api_send_ts_ms', CAST(NULL AS BIGINT), 'source_event_ts_ms', CAST(NULL AS BIGINT), 'filler', true)"
    )
    gap = f"next_start_ms > start_ts_ms + {bin_ms}"
    both = with_next_start(bins).selectExpr("symbol", f"explode(IF({gap}, array({real}, {flat}), array({real}))) AS _run")
    runs = both.selectExpr("symbol", "_run.*")
    hours = _cut_runs(runs, HOUR_MS).repartition("symbol", x.floor_ms("run_start", HOUR_MS))
    cut = _cut_runs(hours, window_ms)
    placed = cut.selectExpr(
        "*",
        f"IF(filler, run_start + pmod(-run_start, {bin_ms}L), run_start) AS first_ms",
        f"IF(filler, run_end + pmod(-run_end, {bin_ms}L) - {bin_ms}, run_start) AS last_ms",
    )
    return placed.where("last_ms >= first_ms").selectExpr(
        "symbol",
        "first_ms",
        "last_ms",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "notional",
        f"(last_ms - first_ms) div {bin_ms} + 1 AS bin_count",
        "api_send_ts_ms",
        "source_event_ts_ms",
    )


def _cut_runs(runs: DataFrame, width_ms: int) -> DataFrame:
    """Cut filler runs where windows of ``width_ms`` begin; a real bin stays whole."""
    first = f"run_start - pmod(run_start, {width_ms}L)"
    last = f"IF(filler, run_end - 1 - pmod(run_end - 1, {width_ms}L), {first})"
    spread = runs.selectExpr("*", f"explode(sequence({first}, {last}, {width_ms}L)) AS _w")
    kept = [c for c in _PIECE if c not in ("run_start", "run_end")]
    return spread.selectExpr(
        *kept,
        "IF(filler, greatest(run_start, _w), run_start) AS run_start",
        f"IF(filler, least(run_end, _w + {width_ms}), run_end) AS run_end",
    )


def fold_pieces(
    parts: DataFrame, ingest: Column | None = None, keep_grain: bool = False
) -> DataFrame:
    """One bar per symbol and second out of pieces that do not cross a second."""
    folded = (
        bar_ops.by_grain(parts, "first_ms")
        .groupBy("symbol", bar_ops.GRAIN, x.floor_ms("first_ms", SECOND_MS).alias("bar_start"))
        .agg(
            F.expr("min_by(open, first_ms) AS open"),
            F.expr("max(high) AS high"),
            F.expr("min(low) AS low"),
            F.expr("max_by(close, last_ms) AS close"),
            F.expr("CAST(sum(volume) AS DECIMAL(38,6)) AS volume"),
            F.expr("CAST(sum(notional) AS DECIMAL(38,6)) AS notional"),
            F.expr("sum(bin_count) AS bin_count"),
            F.expr("0L AS max_lateness_ms"),
            F.expr("min(api_send_ts_ms) AS api_send_ts_ms"),
            F.expr("min(source_event_ts_ms) AS source_event_ts_ms"),
        )
    )
    return bar_ops.finish_bars(folded, ingest, keep_grain)


def filled_bars(
    bins: DataFrame, bin_ms: int = BIN_MS, ingest: Column | None = None, keep_grain: bool = False
) -> DataFrame:
    """One bar for every second between a symbol's first and last bin, as if every bin had been filled in."""
    return fold_pieces(pieces(bins, SECOND_MS, bin_ms), ingest, keep_grain)


def filled_summary(bins: DataFrame, window_ms: int, bin_ms: int = BIN_MS) -> DataFrame:
    """What the filled bins add up to per symbol and window: count, volume, lowest and highest close."""
    return (
        pieces(bins, window_ms, bin_ms)
        .groupBy("symbol", x.floor_ms("first_ms", window_ms).alias("window_start_ms"))
        .agg(
            F.sum("bin_count").alias("bins"),
            F.sum("volume").alias("volume"),
            F.min("close").alias("low_close"),
            F.max("close").alias("high_close"),
        )
    )


def filled_bins(bins: DataFrame, bin_ms: int = BIN_MS, ingest: Column | None = None) -> DataFrame:
    """Every bin between a symbol's first and last one, row by row. Large: prefer the folded forms above."""
    starts = F.sequence("first_ms", "last_ms", F.lit(bin_ms).cast("long"))
    filler = (
        filler_runs(bins, SECOND_MS, bin_ms)
        .withColumn("start_ts_ms", F.explode(starts))
        .select(
            x.series_id("symbol", "start_ts_ms").alias("bin_id"),
            "symbol",
            "start_ts_ms",
            (F.col("start_ts_ms") + bin_ms).alias("end_ts_ms"),
            F.lit(bin_ms).cast("long").alias("window_ms"),
            *[F.col("price").alias(c) for c in ("open", "high", "low", "close")],
            F.lit(0).cast(WIDE).alias("volume"),
            F.lit(0).cast(WIDE).alias("notional"),
            F.lit(0).cast("long").alias("trade_count"),
            F.lit(0).cast("long").alias("max_lateness_ms"),
            F.lit(None).cast("long").alias("api_send_ts_ms"),
            F.lit(None).cast("long").alias("source_event_ts_ms"),
        )
    )
    emitted = F.unix_millis(F.current_timestamp()) if ingest is None else ingest
    filler = filler.withColumn("ingest_ts_ms", emitted).withColumn("source", F.lit(BIN_SOURCE))
    return bins.select(*BIN_COLUMNS).unionByName(filler.select(*BIN_COLUMNS))
