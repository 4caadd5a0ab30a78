"""Ticks to bins, bars, minutes and five-minute bars in one stateful operator per symbol.

The state of a symbol lies in Spark's state store (RocksDB): its newest time, the bins, second and minute that are still
open, its last price, and the minutes waiting for their five-minute bar. A micro-batch is one job: rows are dealt by
symbol, folded with numpy, and what closed goes to one partitioned sink. An idle symbol's open minute is given early by a
processing-time timer.

All rows of a symbol in one micro-batch meet in one task, so the source's limit on a micro-batch bounds it; where a single
symbol fills micro-batches, ``stages`` deals its rows out in chunks at the price of more jobs.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickbars.functions import scalars as x
from tickbars.operators import bars as bar_ops
from tickbars.operators import bins as bin_ops
from tickbars.operators import lateness
from tickbars.operators.rollups import FIVE_MINUTE_SUFFIX, MINUTE_SUFFIX
from tickbars.schemas import PRICE, WIDE
from tickbars.settings import IDLE_SETTLE_MS, MINUTE_MS, SECOND_MS, Settings
from tickbars.sources.ticks import FILE_PLACE

#: Kinds of output rows.
LATE, BIN, BAR, MINUTE, FIVE = "late_tick", "bin", "bar", "minute", "five_minutes"

#: Stands for a missing time on the way through pandas, which would turn a column with nulls into floats.
NEVER = 2**62
MICRO = 1_000_000

_NUMBERS = "open high low close".split()
_SUMS = "volume notional".split()
_WHOLE = "count max_lateness_ms api_send_ts_ms source_event_ts_ms ingest_ts_ms minute_count minute_index arrival_seq".split()
_NAMES = ["kind", "symbol", "start_ts_ms", "end_ts_ms", *_NUMBERS, *_SUMS, *_WHOLE, "final"]
OUTPUT = ", ".join(
    ["kind STRING, symbol STRING, start_ts_ms BIGINT, end_ts_ms BIGINT"]
    + [f"{c} BIGINT" for c in _NUMBERS]
    + [f"{c} STRING" for c in _SUMS]
    + [f"{c} BIGINT" for c in _WHOLE]
    + ["final BOOLEAN"]
)


def rounded(value: int) -> int:
    """An amount in 10^-12 as one in 10^-6, half away from zero, as decimals are cast."""
    whole = (abs(value) + MICRO // 2) // MICRO
    return whole if value >= 0 else -whole


def _join(old: list | None, new: list) -> list:
    """Two parts of a window, the old one first: open, high, low, close, volume, notional, count, lateness, two times."""
    if old is None:
        return new
    return [
        old[0], max(old[1], new[1]), min(old[2], new[2]), new[3], old[4] + new[4], old[5] + new[5], old[6] + new[6],
        max(old[7], new[7]), min(old[8], new[8]), min(old[9], new[9]),
    ]


class SymbolState:
    """What is open for one symbol, and the rows that come out as it advances. Prices and sizes are in millionths."""

    def __init__(self, text: str | None, settings: Settings, ingest: Callable[[int, int], int]) -> None:
        self.settings = settings
        self.ingest = ingest
        known = json.loads(text) if text else {}
        self.newest = known.get("newest", 0)
        self.bins = {int(k): v for k, v in known.get("bins", {}).items()}
        self.last = known.get("last")  # start and close of the last bin that closed
        self.seconds = {int(k): v for k, v in known.get("seconds", {}).items()}
        self.minute = known.get("minute")  # start, window, newest emission
        self.waiting = known.get("waiting", [])
        self.out: list[dict] = []

    def text(self) -> str:
        kept = ("newest", "bins", "last", "seconds", "minute", "waiting")
        return json.dumps({name: getattr(self, name) for name in kept})

    def add(self, at: np.ndarray, price: np.ndarray, size: np.ndarray, sent: np.ndarray, source: np.ndarray, order: np.ndarray) -> None:
        """Fold ticks, in arrival order, into the open bins; ticks too far behind the newest time come out as late."""
        before = np.maximum.accumulate(np.concatenate([[self.newest], at]))[:-1]
        late = np.maximum(before - at, 0)
        for i in np.flatnonzero(late > self.settings.max_late_ms).tolist():
            row = dict(kind=LATE, start_ts_ms=int(at[i]), open=int(price[i]), volume=str(int(size[i])))
            row |= dict(max_lateness_ms=int(late[i]), api_send_ts_ms=int(sent[i]), source_event_ts_ms=int(source[i]), arrival_seq=int(order[i]))
            self.out.append(row)
        good = late <= self.settings.max_late_ms
        if len(at):
            self.newest = max(self.newest, int(at.max()))
        if not good.any():
            return
        at, price, size, sent, source, late = (v[good] for v in (at, price, size, sent, source, late))
        start = at - np.mod(at, self.settings.bin_ms)
        by = np.argsort(start, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(start[by]) != 0))
        tails = np.append(heads[1:], len(by)) - 1
        p = price[by]
        exact = p.astype(object) * size[by].astype(object)
        parts = zip(
            start[by][heads].tolist(), p[heads].tolist(), np.maximum.reduceat(p, heads).tolist(), np.minimum.reduceat(p, heads).tolist(),
            p[tails].tolist(), np.add.reduceat(size[by].astype(object), heads).tolist(), np.add.reduceat(exact, heads).tolist(),
            (tails - heads + 1).tolist(), np.maximum.reduceat(late[by], heads).tolist(), np.minimum.reduceat(sent[by], heads).tolist(),
            np.minimum.reduceat(source[by], heads).tolist(), strict=True,
        )
        for first, *part in parts:
            self.bins[first] = _join(self.bins.get(first), part)

    def advance(self, drain: bool = False) -> None:
        """Close what lies behind the newest time by more than the allowed lateness; with ``drain`` everything."""
        width, late_ms = self.settings.bin_ms, self.settings.max_late_ms
        for start in sorted(s for s in self.bins if drain or s + width < self.newest - late_ms):
            window = self.bins.pop(start)
            window[5] = rounded(window[5])
            self._emit(BIN, start, start + width, window)
            if self.last is not None:
                self._fill(self.last[0] + width, start, self.last[1])
            # Bins come in order, so their own lateness is spent.
            self._into_second(start, [*window[:6], 1, 0, *window[8:]])
            self.last = [start, window[3]]
        if self.last is None:
            return
        for start in sorted(s for s in self.seconds if drain or s + SECOND_MS < self.last[0] + width - late_ms):
            window = self.seconds.pop(start)
            given = self._emit(BAR, start, start + SECOND_MS, window)
            self._into_minute(start, window, given)
        if drain and self.minute is not None:
            self._close_minute()

    def _into_second(self, start: int, part: list) -> None:
        second = start - start % SECOND_MS
        self.seconds[second] = _join(self.seconds.get(second), part)

    def _fill(self, first: int, end: int, price: int) -> None:
        """Flat bins from ``first`` up to ``end``, one part per second."""
        width = self.settings.bin_ms
        while first < end:
            upto = min(end, first - first % SECOND_MS + SECOND_MS)
            count = -(-(upto - first) // width)
            self._into_second(first, [price, price, price, price, 0, 0, count, 0, NEVER, NEVER])
            first += count * width

    def _into_minute(self, start: int, window: list, given: int) -> None:
        minute = start - start % MINUTE_MS
        if self.minute is not None and minute > self.minute[0]:
            self._close_minute()
        part = [*window[:6], 1, *window[7:]]
        if self.minute is None:
            self.minute = [minute, part, given]
        else:
            self.minute = [minute, _join(self.minute[1], part), max(self.minute[2], given)]

    def _close_minute(self) -> None:
        start, window, given = self.minute
        self._emit(MINUTE, start, start + MINUTE_MS, window, given, minute_index=len(self.waiting), final=True)
        self.waiting.append(self.minute)
        self.minute = None
        if len(self.waiting) == self.settings.flush_minutes:
            whole = None
            for _, part, _ in self.waiting:
                whole = _join(whole, part)
            first, last = self.waiting[0][0], self.waiting[-1][0] + MINUTE_MS
            self._emit(FIVE, first, last, whole, max(g for *_, g in self.waiting), minute_count=len(self.waiting))
            self.waiting = []

    def settle(self) -> None:
        """Give the open minute early; it comes again, whole, when it is final."""
        if self.minute is not None:
            start, window, given = self.minute
            self._emit(MINUTE, start, start + MINUTE_MS, window, given, final=False)

    def _emit(self, kind: str, start: int, end: int, window: list, given: int | None = None, **more) -> int:
        given = self.ingest(start, end) if given is None else given
        row = dict(zip([*_NUMBERS[:1], "high", "low", "close"], window[:4], strict=True))
        row |= dict(kind=kind, start_ts_ms=start, end_ts_ms=end, volume=str(window[4]), notional=str(window[5]), count=window[6])
        row |= dict(max_lateness_ms=window[7], api_send_ts_ms=window[8], source_event_ts_ms=window[9], ingest_ts_ms=given)
        self.out.append(row | more)
        return given

    def rows(self, symbol: str) -> pd.DataFrame:
        columns = {name: [row.get(name) for row in self.out] for name in _NAMES if name != "symbol"}
        # Plain objects: neither floats for numbers with gaps nor chunked strings.
        frame = pd.DataFrame({"symbol": [symbol] * len(self.out), **columns}, dtype=object)[_NAMES]
        whole = ["start_ts_ms", "end_ts_ms", *_NUMBERS, *_WHOLE]
        return frame.astype({**dict.fromkeys(whole, "Int64"), "final": "boolean"})


def wall_clock(start: int, end: int) -> int:
    return int(time.time() * 1000)


class TickProcessor(StatefulProcessor):
    """One symbol's state in the state store, as text that is written once per micro-batch."""

    def __init__(self, settings: Settings, ingest: Callable[[int, int], int] = wall_clock, idle_ms: int | None = IDLE_SETTLE_MS) -> None:
        self.settings = settings
        self.ingest = ingest
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("symbol", "text STRING")

    def _known(self) -> SymbolState:
        return SymbolState(self.state.get()[0] if self.state.exists() else None, self.settings, self.ingest)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._known()
        ticks = pd.concat(list(rows), ignore_index=True)
        drain = bool(ticks["drain"].any())
        ticks = ticks[~ticks["drain"].astype(bool)]
        ticks = ticks.sort_values([c for c in ticks.columns if c.startswith("_order")], kind="stable")
        names = ["event_ts_ms", "price", "size", "api_send_ts_ms", "source_event_ts_ms", "arrival_seq"]
        state.add(*(ticks[n].to_numpy(np.int64) for n in names))
        state.advance(drain)
        self.state.update((state.text(),))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if state.minute is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield state.rows(key[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self._known()
        state.settle()
        yield state.rows(key[0])

    def close(self) -> None:
        pass


def fold_stream(
    ticks: DataFrame,
    settings: Settings | None = None,
    ingest: Callable[[int, int], int] = wall_clock,
    idle_ms: int | None = IDLE_SETTLE_MS,
) -> DataFrame:
    """The stream of everything that comes out of a stream of ticks, one row each, told apart by ``kind``.

    ``ticks`` has ``symbol, px, sz, event_ts_ms, api_send_ts_ms, source_event_ts_ms`` and either ``arrival_seq`` or the place
    in files that ``sources.ticks`` adds; a boolean ``drain``, if there is one, marks rows that carry no tick but close
    everything their symbol has open. ``ingest`` gives a window's emission time from its start and end. Take the rows apart
    with ``bins_of``, ``bars_of``, ``minutes_of``, ``five_minutes_of`` and ``late_of``.
    """
    settings = settings or Settings()
    columns = set(ticks.columns)
    if "arrival_seq" in columns:
        order = [F.col("arrival_seq").alias("_order_0")]
    elif FILE_PLACE in columns:
        order = [F.col(f"{FILE_PLACE}.{part}").alias(f"_order_{k}") for k, part in enumerate(("time", "path", "at"))]
        order.append(F.monotonically_increasing_id().alias("_order_3"))
    else:
        order = [F.monotonically_increasing_id().alias("_order_0")]

    def unscaled(name: str) -> Column:
        return F.coalesce((F.col(name).cast(PRICE) * MICRO).cast("bigint"), F.lit(0).cast("bigint"))

    def moment(name: str) -> Column:
        return F.coalesce(F.col(name).cast("bigint"), F.lit(NEVER).cast("bigint"))

    picked = ticks.select(
        "symbol",
        moment("event_ts_ms").alias("event_ts_ms"),
        unscaled("px").alias("price"),
        unscaled("sz").alias("size"),
        moment("api_send_ts_ms").alias("api_send_ts_ms"),
        moment("source_event_ts_ms").alias("source_event_ts_ms"),
        (F.col("arrival_seq") if "arrival_seq" in columns else F.monotonically_increasing_id()).alias("arrival_seq"),
        (F.coalesce("drain", F.lit(False)) if "drain" in columns else F.lit(False)).alias("drain"),
        *order,
    )
    mode = "ProcessingTime" if idle_ms is not None else "None"
    return picked.groupBy("symbol").transformWithStateInPandas(TickProcessor(settings, ingest, idle_ms), OUTPUT, "Append", mode)


def _amount(name: str, kind: str = WIDE) -> Column:
    return (F.col(name).cast("decimal(38,0)") / F.lit(MICRO)).cast(kind).alias(name)


def _when(name: str) -> Column:
    return F.when(F.col(name) < NEVER, F.col(name)).alias(name)


def _windows(rows: DataFrame, kind: str, count: str, *more: str | Column) -> DataFrame:
    picked = rows.where(F.col("kind") == kind)
    return picked.select("symbol", "start_ts_ms", "end_ts_ms", *(_amount(c, PRICE) for c in _NUMBERS), *map(_amount, _SUMS), F.col("count").alias(count), *more)


def bins_of(rows: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The bins among the output rows, as ``bins.fold_ticks`` gives them."""
    folded = _windows(rows, BIN, "trade_count", "max_lateness_ms", _when("api_send_ts_ms"), _when("source_event_ts_ms"), F.col("ingest_ts_ms").alias("_given"))
    made = bin_ops.finish_bins(folded.drop("end_ts_ms"), (settings or Settings()).bin_ms, F.col("_given"))
    return made.select(*bin_ops.BIN_COLUMNS)


def bars_of(rows: DataFrame) -> DataFrame:
    """The one-second bars among the output rows, as ``gapfill.filled_bars`` gives them."""
    folded = _windows(rows, BAR, "bin_count", "max_lateness_ms", _when("api_send_ts_ms"), _when("source_event_ts_ms"), F.col("ingest_ts_ms").alias("_given"))
    return bar_ops.finish_bars(folded.drop("end_ts_ms").withColumnRenamed("start_ts_ms", "bar_start"), F.col("_given"))


def minutes_of(rows: DataFrame) -> DataFrame:
    """The minute bars with whether they are ``final`` and, if so, their ``minute_index``."""
    minutes = _windows(rows, MINUTE, "source_count", "ingest_ts_ms", "minute_index", "final")
    return minutes.withColumn("bar_id", x.series_id("symbol", "start_ts_ms", MINUTE_SUFFIX))


def five_minutes_of(rows: DataFrame) -> DataFrame:
    """Bars of as many consecutive present minutes as a flush has, as ``rollups.counted_batches`` gives them."""
    made = _windows(rows, FIVE, "source_count", "ingest_ts_ms", "minute_count")
    return made.withColumn("bar_id", x.series_id("symbol", "start_ts_ms", FIVE_MINUTE_SUFFIX))


def late_of(rows: DataFrame) -> DataFrame:
    """Dead letters of ticks that came too late."""
    tick = F.struct("arrival_seq", _amount("open", PRICE).alias("px"), _amount("volume", PRICE).alias("sz"), _when("api_send_ts_ms"), _when("source_event_ts_ms"))
    return rows.where(F.col("kind") == LATE).select(
        F.lit(lateness.LATE_TICK).alias("reason"),
        F.col("max_lateness_ms").alias("lateness_ms"),
        "symbol",
        F.col("start_ts_ms").alias("event_ts_ms"),
        tick.alias("tick"),
    )


def use_state_store(spark: SparkSession) -> None:
    """Queries started from here on keep their state in RocksDB, with change logs in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def start(rows: DataFrame, path: str, checkpoint: str, until_idle: bool = False) -> StreamingQuery:
    """Append the output rows to files at ``path``, a folder per kind, each row exactly once. One job a micro-batch."""
    use_state_store(rows.sparkSession)
    writer = rows.writeStream.format("parquet").partitionBy("kind").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_idle else writer).start()


def read(spark: SparkSession, path: str) -> DataFrame:
    """What the sink holds so far."""
    return spark.read.schema(OUTPUT).parquet(path)
