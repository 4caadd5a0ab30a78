"""Quote snapshots: normalisation, and filling missing prices from minute history."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators import ordering
from tickbars.settings import DAY_MS, HOUR_MS, MINUTE_MS

# Source tags of live and of backfilled quotes, the least and longest pause between two history look-ups.
LIVE_SOURCE = "yfinance.fast_info"
HISTORY_SOURCE = "yfinance.history"
REFETCH_MS = 30_000
MAX_REFETCH_MS = 300_000

#: Where a chain of fetches ends.
NOWHERE = -(2**62)


def _some(name: str) -> Column:
    """The number unless it is zero or missing."""
    return F.nullif(F.col(name), F.lit(0.0))


def normalize_quotes(quotes: DataFrame) -> DataFrame:
    """Quote events; the size is the first of last, bid and ask size that is there and not zero."""
    return quotes.select(
        "quote_id",
        "symbol",
        F.col("last_price").alias("px"),
        "bid",
        "ask",
        F.coalesce(_some("last_size"), _some("bid_size"), _some("ask_size")).alias("sz"),
        F.col("quote_ts_ms").alias("event_ts_ms"),
        F.lit(LIVE_SOURCE).alias("source"),
        F.col("quote_ts_ms").alias("api_send_ts_ms"),
    )


def history_at(wanted: DataFrame, minutes: DataFrame) -> DataFrame:
    """For each symbol and minute in ``wanted``, the last minute bar at or before it.

    Bars start on whole minutes, so the bar that counts for a quote depends on the quote's minute alone. The
    as-of look-up therefore runs on distinct (symbol, minute) pairs, a grid, with the last bar of a day carried
    into the following days; the quotes themselves are joined by equality.
    """
    bars = minutes.select(
        "symbol",
        F.col("start_ts_ms").alias("minute_ms"),
        F.struct(
            F.col("start_ts_ms").alias("bar_ts_ms"),
            F.col("close").cast("double").alias("bar_close"),
            F.col("volume").cast("double").alias("bar_volume"),
        ).alias("_bar"),
        F.lit(False).alias("_asked"),
    )
    asked = wanted.select("symbol", "minute_ms").distinct()
    grid = (
        asked.select("symbol", "minute_ms", F.lit(None).cast(bars.schema["_bar"].dataType).alias("_bar"), F.lit(True).alias("_asked"))
        .unionByName(bars)
        .withColumn(ordering.CHUNK, x.floor_ms("minute_ms", DAY_MS))
    )
    handed = ordering.carry(
        grid,
        ["symbol"],
        ordering.CHUNK,
        [F.max_by("_bar", F.when(F.col("_bar").isNotNull(), F.col("minute_ms"))).alias("_day_last")],
        lambda over: [F.last("_day_last", ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, -1)).alias("_earlier")],
    )
    inside = (
        W.partitionBy("symbol", ordering.CHUNK)
        .orderBy("minute_ms", "_asked")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    bar = F.coalesce(F.last("_bar", ignorenulls=True).over(inside), F.col("_earlier"))
    return handed.withColumn("_found", bar).where("_asked").select("symbol", "minute_ms", "_found.*")


def wait_levels(wait_ms: int, max_wait_ms: int) -> list[int]:
    """The waits after a fetch: the first one after success, the next ones after one, two, ... empty fetches in a row."""
    levels = [wait_ms]
    while min(2 * levels[-1], max_wait_ms) not in levels:
        levels.append(min(2 * levels[-1], max_wait_ms))
    return levels


def walk(times: np.ndarray, found: np.ndarray, waits: np.ndarray, at: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Follow several chains of fetches at once through the asks of a stretch.

    A chain enters at ask ``at`` with a level of waiting; gives when each may fetch next after the stretch, its level then,
    and the asks at which chains fetched, step by step.
    """
    at, level = at.copy(), level.copy()
    after = np.full(len(at), NOWHERE, np.int64)
    steps = []
    alive = np.flatnonzero(at < len(times))
    while len(alive):
        now = at[alive]
        steps.append(now)
        level[alive] = np.where(found[now], 0, np.minimum(level[alive] + 1, len(waits) - 1))
        after[alive] = times[now] + waits[level[alive]]
        at[alive] = np.searchsorted(times, after[alive])
        alive = alive[at[alive] < len(times)]
    return after, level, steps


def _sorted_asks(asks: pa.Table) -> pa.Table:
    return asks.sort_by("event_ts_ms")


def _entries_to_exits(waits: np.ndarray):
    """Where chains leave a stretch, for every ask and level at which one can enter it: by an ask within the longest wait from
    its start, or by the first one after that."""

    def run(key: tuple[pa.Scalar, ...], asks: pa.Table) -> pa.Table:
        asks = _sorted_asks(asks)
        times, found = asks.column("event_ts_ms").to_numpy(), asks.column("found").to_numpy(zero_copy_only=False)
        many = min(int(np.searchsorted(times, key[1].as_py() + waits.max())) + 1, len(times))
        at = np.repeat(np.arange(many), len(waits))
        level = np.tile(np.arange(len(waits)), many)
        after, left_at, _ = walk(times, found, waits, at, level)
        columns = [pa.array([key[0].as_py()] * len(at), pa.string()), pa.array(times[at]), pa.array(level), pa.array(after), pa.array(left_at)]
        return pa.table(columns, names=["symbol", "event_ts_ms", "level", "after_ms", "next_level"])

    return run


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries that a symbol's one chain passes. Links arrive by symbol, time and level, and lead forward in time, so only
    the entry sought is remembered."""
    symbol, sought = None, None
    names = ["symbol", "event_ts_ms", "level"]
    for batch in batches:
        names_of = batch.column("symbol").to_pylist()
        times, levels, to_time, to_level = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("event_ts_ms", "level", "to_ms", "to_level"))
        taken = []
        start = 0
        while start < len(names_of):
            end = int(np.searchsorted(np.array(names_of[start:], object) != names_of[start], True)) + start
            if names_of[start] != symbol:
                symbol, sought = names_of[start], (int(times[start]), 0)
            while sought is not None:
                # Every entry has all levels, one after the other; a batch may end between them.
                first = start + int(np.searchsorted(times[start:end], sought[0]))
                if first == end or times[first] != sought[0] or first + sought[1] - levels[first] >= end:
                    break
                hit = first + sought[1] - int(levels[first])
                taken.append(hit)
                sought = (int(to_time[hit]), int(to_level[hit])) if to_time[hit] != NOWHERE else None
            start = end
        yield batch.select(names).take(pa.array(taken, pa.int64()))


def _fetches_within(waits: np.ndarray, names: list[str]):
    """The successful fetches of a stretch, from the entry of its chain on; a stretch the chain leaps over has none."""

    def run(key: tuple[pa.Scalar, ...], asks: pa.Table) -> pa.Table:
        asks = _sorted_asks(asks)
        times, found = asks.column("event_ts_ms").to_numpy(), asks.column("found").to_numpy(zero_copy_only=False)
        entry, level = asks.column("entry_ms")[0].as_py(), asks.column("level")[0].as_py()
        at = np.zeros(0, np.int64)
        if entry is not None:
            _, _, steps = walk(times, found, waits, np.searchsorted(times, [entry]), np.array([level]))
            at = np.concatenate(steps)
        hits = asks.take(pa.array(at[found[at]]))
        return hits.select(["symbol", "event_ts_ms", "quote_id", *names]).rename_columns(["symbol", "lead_ts_ms", "lead_id", *names])

    return run


def history_fetches(asks: DataFrame, wait_ms: int = REFETCH_MS, max_wait_ms: int = MAX_REFETCH_MS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Which of the quotes without a price fetch history with success: ``symbol, lead_ts_ms, lead_id``, and the columns
    ``keep`` of the asks that fetched.

    ``asks`` has ``symbol, quote_id, event_ts_ms`` and whether history is ``found`` at that time. A symbol's first ask
    fetches; after a fetch the next one waits ``wait_ms``, and after an empty one twice the wait before, up to
    ``max_wait_ms``; in between nothing is fetched. The chain of fetches goes on over hours and days.

    Hours are worked on side by side: each tells where chains that enter it leave it, for all asks at which one can enter,
    which are those of its first minutes. Exits are linked with the entries after them, the one real chain is followed over
    these links, and the hours give its fetches. An hour holds an ask per millisecond at most; links alone are ordered by
    symbol, and read once.
    """
    levels = wait_levels(wait_ms, max_wait_ms)
    waits = np.array(levels, np.int64)
    # One aggregate with all that later steps need, so that they share its shuffle.
    first = F.min(F.struct("quote_id", *keep)).alias("_first")
    moments = asks.groupBy("symbol", "event_ts_ms").agg(first, F.max("found").alias("found"))
    moments = moments.select("symbol", "event_ts_ms", "found", "_first.*")
    hours = moments.withColumn("hour_ms", x.floor_ms("event_ts_ms", HOUR_MS))
    entry = "symbol string, event_ts_ms long, level long, after_ms long, next_level long"
    exits = hours.groupBy("symbol", "hour_ms").applyInArrow(_entries_to_exits(waits), entry)
    # The entry an exit leads to is the first one at or after it, in its own hour or a later one.
    target = "named_struct('at_ms', event_ts_ms, 'target', event_ts_ms, '_from', CAST(NULL AS STRUCT<event_ts_ms: BIGINT, level: BIGINT, next_level: BIGINT>))"
    probe = "named_struct('at_ms', after_ms, 'target', CAST(NULL AS BIGINT), '_from', named_struct('event_ts_ms', event_ts_ms, 'level', level, 'next_level', next_level))"
    both = exits.selectExpr("symbol", f"explode(IF(level = 0, array({target}, {probe}), array({probe}))) AS _row").select("symbol", "_row.*")
    # Links are few beside the asks, so a symbol's may be ordered as a whole, latest first: the least target so far is next.
    onward = W.partitionBy("symbol").orderBy(F.desc("at_ms")).rangeBetween(W.unboundedPreceding, W.currentRow)
    linked = both.withColumn("to_ms", F.coalesce(F.min("target").over(onward), F.lit(NOWHERE).cast("long")))
    links = linked.where("_from IS NOT NULL").select("symbol", "_from.event_ts_ms", "_from.level", "to_ms", F.col("_from.next_level").alias("to_level"))
    ordered = links.repartition("symbol").sortWithinPartitions("symbol", "event_ts_ms", "level")
    entered = ordered.mapInArrow(_follow, "symbol string, event_ts_ms long, level long")
    entered = entered.select("symbol", x.floor_ms("event_ts_ms", HOUR_MS).alias("hour_ms"), F.col("event_ts_ms").alias("entry_ms"), "level")
    kind = asks.schema["quote_id"].dataType.simpleString()
    known = hours.join(entered, ["symbol", "hour_ms"], "left")
    kept = "".join(f", {c} {asks.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"symbol string, lead_ts_ms long, lead_id {kind}{kept}"
    return known.groupBy("symbol", "hour_ms").applyInArrow(_fetches_within(waits, list(keep)), schema)


def backfill(quotes: DataFrame, minutes: DataFrame, refetch_ms: int = REFETCH_MS, max_refetch_ms: int = MAX_REFETCH_MS) -> DataFrame:
    """Fill quotes without a price from minute history.

    A quote that fetches history (see ``history_fetches``) takes the last bar's close as price, as bid and ask where it
    has none, the bar's volume as size where it has none, and the bar's time and the history tag. Quotes in between
    reuse the values of the last successful one where their own are missing, and keep their own time and tag.
    ``refetch_ms=0`` looks history up for every quote.
    """
    needy = F.col("px").isNull()
    slotted = quotes.withColumn("minute_ms", x.floor_ms("event_ts_ms", MINUTE_MS))
    lacking = slotted.where(needy)
    found = history_at(lacking, minutes)
    if refetch_ms <= 0:
        looked = slotted.join(found, ["symbol", "minute_ms"], "left")
        return _from_history(looked, needy & F.col("bar_close").isNotNull()).select(*quotes.columns)

    looked = lacking.join(found, ["symbol", "minute_ms"], "left").withColumn("found", F.col("bar_close").isNotNull())
    values = ["bid", "ask", "sz", "bar_ts_ms", "bar_close", "bar_volume"]
    fetched = history_fetches(looked, refetch_ms, max_refetch_ms, tuple(values))
    lead = F.struct(F.col("lead_id").alias("quote_id"), F.col("lead_ts_ms").alias("event_ts_ms"), *values).alias("_lead")
    leaders = fetched.select("symbol", lead)
    # Fetches lie a wait apart, so a slot of that width holds one at most; earlier ones are carried over slots and days.
    slot = x.floor_ms("event_ts_ms", refetch_ms)
    own = leaders.select("symbol", x.floor_ms("_lead.event_ts_ms", refetch_ms).alias("_slot"), "_lead")
    grid = lacking.select("symbol", slot.alias("_slot")).distinct().join(own, ["symbol", "_slot"], "left")
    handed = ordering.carry(
        grid.withColumn(ordering.CHUNK, x.floor_ms("_slot", DAY_MS)),
        ["symbol"],
        ordering.CHUNK,
        [F.max_by("_lead", F.when(F.col("_lead").isNotNull(), F.col("_slot"))).alias("_day_last")],
        lambda over: [F.last("_day_last", ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, -1)).alias("_day_before")],
    )
    before = W.partitionBy("symbol", ordering.CHUNK).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.coalesce(F.last("_lead", ignorenulls=True).over(before), F.col("_day_before"))
    carried = handed.select("symbol", "_slot", "_lead", earlier.alias("_earlier"))
    joined = slotted.withColumn("_slot", slot).join(carried, ["symbol", "_slot"], "left")
    use = F.when(F.col("_lead.event_ts_ms") <= F.col("event_ts_ms"), F.col("_lead")).otherwise(F.col("_earlier"))
    joined = joined.withColumn("_use", F.when(needy, use)).select(
        "*", *[F.col(f"_use.{c}").alias(c) for c in ("bar_ts_ms", "bar_close", "bar_volume")]
    )
    has = F.col("_use").isNotNull()
    first = has & (F.col("quote_id") == F.col("_use.quote_id"))
    follower = has & (F.col("quote_id") != F.col("_use.quote_id"))
    reused = (
        joined.withColumn("_first", first)
        .withColumn("_follower", follower)
        .withColumn("bid", F.when(F.col("_follower"), F.coalesce("bid", "_use.bid", "bar_close")).otherwise(F.col("bid")))
        .withColumn("ask", F.when(F.col("_follower"), F.coalesce("ask", "_use.ask", "bar_close")).otherwise(F.col("ask")))
        .withColumn("sz", F.when(F.col("_follower"), F.coalesce("sz", "_use.sz", "bar_volume")).otherwise(F.col("sz")))
        .withColumn("px", F.when(F.col("_follower"), F.col("bar_close")).otherwise(F.col("px")))
    )
    return _from_history(reused, F.col("_first")).select(*quotes.columns)


def _from_history(rows: DataFrame, when: Column) -> DataFrame:
    marked = rows.withColumn("_take", F.coalesce(when, F.lit(False)))
    take = F.col("_take")
    return (
        marked.withColumn("px", F.when(take, F.col("bar_close")).otherwise(F.col("px")))
        .withColumn("bid", F.when(take, F.coalesce("bid", "bar_close")).otherwise(F.col("bid")))
        .withColumn("ask", F.when(take, F.coalesce("ask", "bar_close")).otherwise(F.col("ask")))
        .withColumn("sz", F.when(take, F.coalesce("sz", "bar_volume")).otherwise(F.col("sz")))
        .withColumn("event_ts_ms", F.when(take, F.col("bar_ts_ms")).otherwise(F.col("event_ts_ms")))
        .withColumn("source", F.when(take, F.lit(HISTORY_SOURCE)).otherwise(F.col("source")))
    )


def quote_rows(events: DataFrame, epoch_seconds: str = "event_ts") -> DataFrame:
    """Rows of the quotes table: symbol, price, and the UTC timestamp of the quote's epoch seconds."""
    return events.select(
        "symbol", F.col("px").cast("double").alias("price"), F.timestamp_seconds(F.col(epoch_seconds)).alias("ts")
    )
