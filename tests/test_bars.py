from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickbars.operators import bars, bins, gapfill, lateness, rollups
from tickbars.settings import Settings

T0 = 1_735_822_800_000


def _fold(frame, **kwargs):
    classified = lateness.with_lateness(frame, "arrival_seq", "event_ts_ms")
    return bins.fold_ticks(lateness.accepted(classified), **kwargs)


def test_open_and_close_follow_arrival(ticks_of):
    rows = [("A", T0 + 5, 10, 1), ("A", T0 + 9, 12, 2), ("A", T0 + 1, 11, 3)]
    (row,) = _fold(ticks_of(rows)).collect()
    assert (row.open, row.high, row.low, row.close) == (10, 12, 10, 11)
    assert (row.volume, row.notional, row.trade_count, row.max_lateness_ms) == (6, 67, 3, 8)
    assert (row.bin_id, row.end_ts_ms, row.window_ms, row.source) == (f"A-{T0:013d}", T0 + 10, 10, "replay")
    (row,) = _fold(ticks_of(rows), order="event_ts_ms").collect()
    assert (row.open, row.close) == (11, 12)


def test_bin_width(ticks_of):
    rows = [("A", 100, 1, 1), ("A", 124, 2, 1), ("A", 125, 3, 1)]
    got = _fold(ticks_of(rows), bin_ms=25).orderBy("start_ts_ms").collect()
    assert [(r.start_ts_ms, r.end_ts_ms, r.trade_count) for r in got] == [(100, 125, 2), (125, 150, 1)]
    with pytest.raises(ValueError):
        Settings(bin_ms=0)


def test_redelivered_bins_count_once(bins_of):
    once = bins_of([("A", T0, 5, 2), ("A", T0 + 10, 6, 2)])
    got = bars.fold_bins(bins.dedupe(once.unionByName(once))).collect()
    assert [(r.volume, r.bin_count) for r in got] == [(4, 2)]


def test_vwap_falls_back_to_close(bins_of):
    flat, traded = bars.fold_bins(bins_of([("A", T0, 5, 0), ("A", T0 + 1000, 7, 3)])).orderBy("start_ts_ms").collect()
    assert (flat.volume, flat.vwap) == (0, 5.0)
    assert (traded.vwap, traded.bar_id) == (7.0, f"A-{T0 + 1000:013d}")


def _dense(rows):
    """Brute force: fill the grid of each symbol and fold it by second."""
    out = {}
    for symbol in {r[0] for r in rows}:
        have = {t: (px, v) for s, t, px, v in rows if s == symbol}
        close = None
        for t in range(min(have), max(have) + 10, 10):
            px, v = have.get(t, (close, 0))
            close = px
            key = (symbol, t - t % 1000)
            o, h, lo, _, vol, n = out.get(key, (px, px, px, px, 0, 0))
            out[key] = (o, max(h, px), min(lo, px), px, vol + v, n + 1)
    return out


@pytest.mark.parametrize(
    "rows",
    [
        [("A", T0, 5, 1), ("A", T0 + 10, 6, 1), ("A", T0 + 990, 7, 1), ("A", T0 + 2000, 8, 1)],
        [("A", T0 + 500, 5, 1)],
        [("A", T0 + 3_599_990, 5, 1), ("A", T0 + 3_600_000, 6, 1), ("A", T0 + 7_300_010, 4, 2), ("B", T0, 1, 1)],
    ],
)
def test_gaps_against_dense_filling(bins_of, rows):
    frame = bins_of(rows)
    got = {
        (r.symbol, r.start_ts_ms): (r.open, r.high, r.low, r.close, r.volume, r.bin_count)
        for r in gapfill.filled_bars(frame).collect()
    }
    assert got == _dense(rows)


def test_gaps_on_random_bins(bins_of):
    rng = random.Random(3)
    rows = [
        (s, T0 + t * 10, rng.randint(1, 9), rng.randint(0, 3))
        for s in "AB"
        for t in sorted(rng.sample(range(0, 1500), 60))
    ]
    frame = bins_of(rows)
    got = {
        (r.symbol, r.start_ts_ms): (r.open, r.high, r.low, r.close, r.volume, r.bin_count)
        for r in gapfill.filled_bars(frame).collect()
    }
    assert got == _dense(rows)
    filled = gapfill.filled_bins(frame)
    refolded = bars.fold_bins(filled).select("bar_id", "open", "high", "low", "close", "volume", "bin_count")
    direct = gapfill.filled_bars(frame).select("bar_id", "open", "high", "low", "close", "volume", "bin_count")
    assert refolded.exceptAll(direct).count() == 0 and direct.exceptAll(refolded).count() == 0
    summary = gapfill.filled_summary(frame, 60_000).agg(F.sum("bins")).first()[0]
    assert summary == filled.count()


def test_bin_width_that_does_not_divide_a_second(bins_of):
    frame = bins_of([("A", 70, 5, 1), ("A", 2100, 6, 1)])
    got = gapfill.filler_runs(frame, 1000, bin_ms=70).orderBy("first_ms").collect()
    assert [(r.first_ms, r.last_ms, r.bin_count) for r in got] == [(140, 980, 13), (1050, 1960, 14), (2030, 2030, 1)]


def test_volume_is_kept_from_bins_to_minutes(bins_of):
    frame = bins_of([("A", T0 + i * 730, 5 + i % 3, i) for i in range(200)])
    seconds = bars.fold_bins(frame, keep_grain=True)
    minutes = rollups.minute_bars(seconds)
    totals = [f.agg(F.sum("volume")).first()[0] for f in (frame, seconds, minutes, rollups.aligned_five_minutes(minutes))]
    assert len(set(totals)) == 1
    for level in (seconds, minutes):
        assert level.where("low > open OR low > close OR high < open OR high < close").count() == 0


def test_count_batches_against_clock(bars_of):
    minute = 60_000
    starts = [0, 1, 2, 4, 5, 6, 7]
    frame = bars_of([("A", T0 + m * minute, m + 1, 1) for m in starts])
    minutes = rollups.minute_bars(frame)
    (counted,) = rollups.counted_batches(minutes).collect()
    assert (counted.start_ts_ms, counted.end_ts_ms, counted.minute_count) == (T0, T0 + 6 * minute, 5)
    assert counted.bar_id == f"A-{T0:013d}-300s"
    aligned = rollups.aligned_five_minutes(minutes).orderBy("start_ts_ms").collect()
    assert [(r.start_ts_ms - T0, r.minute_count, r.source_count) for r in aligned] == [(0, 4, 4), (300_000, 3, 3)]
    index = rollups.minute_index(minutes).orderBy("start_ts_ms").collect()
    assert [r.minute_index for r in index] == [0, 1, 2, 3, 4, 0, 1]


def test_ordinals_run_across_days(bars_of):
    day = 86_400_000
    frame = rollups.minute_bars(bars_of([("A", T0 + d * day + m * 60_000, 1, 1) for d in (0, 1, 5) for m in range(4)]))
    got = rollups.with_minute_ordinal(frame).orderBy("start_ts_ms").collect()
    assert [r.minute_ordinal for r in got] == list(range(1, 13))


def test_late_second_joins_its_minute(bars_of):
    frame = bars_of([("A", T0, 1, 1), ("A", T0 + 60_000, 2, 1), ("A", T0 + 1000, 3, 1)])
    first = rollups.minute_bars(frame).orderBy("start_ts_ms").first()
    assert (first.source_count, first.high, first.close) == (2, 3, 3)


def test_last_copy_of_a_bar_wins(bars_of):
    first = bars_of([("A", T0, 1, 1), ("B", T0, 2, 2)]).withColumn("arrival_seq", F.lit(1))
    again = bars_of([("A", T0, 9, 9)]).withColumn("arrival_seq", F.lit(2))
    nobody = bars_of([("C", T0, 1, 1)]).withColumn("arrival_seq", F.lit(3)).withColumn("bar_id", F.lit(None).cast("string"))
    union = first.unionByName(again).unionByName(nobody)
    got = {r.symbol: r.close for r in bars.last_per_key(union).collect()}
    assert got == {"A": 9, "B": 2}
    assert bars.without_key(union).count() == 1


def test_thin_log_records(spark):
    log = spark.createDataFrame(
        [("", 1000, Decimal("2"), Decimal("3"), 4), ("A", 1010, Decimal("5"), None, None)],
        "symbol STRING, start_ts_ms BIGINT, price DECIMAL(18,6), sz DECIMAL(18,6), max_lateness_ms BIGINT",
    )
    got = {r.symbol: (r.open, r.volume, r.notional, r.vwap, r.max_lateness_ms) for r in bars.expected_bars(log).collect()}
    assert got == {"UNKNOWN": (2, 3, 6, 2.0, 4), "A": (5, 0, 0, 5.0, 0)}
