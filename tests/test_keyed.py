"""The keyed stream operator beside the batch operators."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickbars.operators import bins, facts, gapfill, lateness, rollups
from tickbars.plans.feed import emitted_ms
from tickbars.settings import Settings
from tickbars.streaming import keyed

T0 = 1_735_822_800_000
LOAD = dt.datetime(2025, 1, 3)
SETTINGS = Settings(flush_minutes=2)


def emitted(start, end):
    """``feed.emitted_ms`` as plain numbers."""
    return end + 500 + start // 10 % 200


def _random_ticks(count, spread_ms, seed=17):
    """Disordered arrivals; symbol B runs an hour ahead of A, C trades in two stretches."""
    rng = random.Random(seed)
    rows, now = [], T0
    for k in range(count):
        now += rng.randint(0, spread_ms)
        symbol = rng.choice("AABC" if k < 50 or k > count - 50 else "AAB")
        ahead = 3_600_000 if symbol == "B" else 0
        at = now + ahead - rng.choice([0, 0, 0, 200, 499, 500, 501, 2000])
        rows.append((symbol, at, rng.randint(1, 90_000_000) / 10**6, rng.randint(0, 5_000_000) / 10**6))
    return rows


def _same(a, b, *columns):
    left, right = a.select(*columns), b.select(*columns)
    assert left.exceptAll(right).limit(3).collect() == [] and right.exceptAll(left).limit(3).collect() == []


def _run(spark, frame, folder, cuts, **given):
    """The ticks as micro-batches cut at arrival numbers, then one that drains every symbol."""
    marked = frame.withColumn("drain", F.lit(False))
    symbols = frame.select("symbol").distinct()
    like = marked.limit(0)
    drain = like.unionByName(symbols.withColumn("drain", F.lit(True)), allowMissingColumns=True)
    edges = [-1, *cuts, 10**9]
    for low, high in zip(edges, edges[1:]):
        marked.where(F.col("arrival_seq").between(low + 1, high)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    query(spark, marked.schema, folder, **given)
    drain.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    progress = query(spark, marked.schema, folder, **given)
    return keyed.read(spark, f"{folder}/out"), progress


def query(spark, schema, folder, **given):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    rows = keyed.fold_stream(stream, given.pop("settings", SETTINGS), emitted, given.pop("idle_ms", None))
    running = keyed.start(rows, f"{folder}/out", f"{folder}/cp", until_idle=True)
    running.awaitTermination()
    return running.recentProgress


def test_drained_equals_batch(spark, ticks_of, tmp_path):
    """Four micro-batches and a restart in between: every kind of row is what the batch operators give."""
    frame = ticks_of(_random_ticks(400, 2000)).withColumn("api_send_ts_ms", F.expr("IF(arrival_seq % 3 = 0, NULL, api_send_ts_ms)"))
    out, _ = _run(spark, frame, str(tmp_path), [99, 100, 230])
    judged = lateness.with_lateness(frame, "arrival_seq", "event_ts_ms")
    batch_bins = bins.fold_ticks(lateness.accepted(judged), ingest=emitted_ms())
    _same(keyed.bins_of(out), batch_bins, *batch_bins.columns)
    batch_bars = gapfill.filled_bars(batch_bins, ingest=emitted_ms())
    _same(keyed.bars_of(out), batch_bars, *batch_bars.columns)
    minutes = rollups.minute_bars(batch_bars)
    indexed = rollups.minute_index(minutes, 2).withColumn("minute_index", F.col("minute_index").cast("long"))
    made = keyed.minutes_of(out)
    assert made.where("NOT final").isEmpty()
    _same(made, indexed, "bar_id", *[c for c in minutes.columns if c != "bar_id"], "minute_index")
    five = rollups.counted_batches(minutes, 2)
    assert five.count() >= 4
    _same(keyed.five_minutes_of(out), five, *five.columns)
    _same(facts.fact_300s(keyed.five_minutes_of(out), LOAD), facts.fact_300s(five, LOAD), "bar_id", "volume", "minute_count")
    letters = lateness.late_tick_letters(judged)
    assert letters.count() > 5
    flat = ["reason", "lateness_ms", "symbol", "event_ts_ms", "tick.arrival_seq", "tick.px", "tick.sz", "tick.api_send_ts_ms"]
    _same(keyed.late_of(out), letters, *flat)


def test_large_amounts_stay_exact(spark, ticks_of, tmp_path):
    """Products beyond 64 bits, and half-way roundings of either sign."""
    rows = [("A", T0 + k, "999999999999.999999", "999999.999999") for k in range(5)]
    rows += [("B", T0 + k, "-0.001", "0.0005") for k in range(3)] + [("B", T0 + 20, "0.001", "0.0005")]
    frame = ticks_of([(s, t, Decimal(p), Decimal(z)) for s, t, p, z in rows])
    out, _ = _run(spark, frame, str(tmp_path), [2])
    judged = lateness.with_lateness(frame, "arrival_seq", "event_ts_ms")
    batch = bins.fold_ticks(lateness.accepted(judged), ingest=emitted_ms())
    _same(keyed.bins_of(out), batch, "bin_id", "open", "volume", "notional", "trade_count")


def test_open_windows_wait(spark, ticks_of, tmp_path):
    """Without a drain nothing comes out that a further tick may still change."""
    frame = ticks_of([("A", T0, 5, 1), ("A", T0 + 400, 6, 1)]).withColumn("drain", F.lit(False))
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    query(spark, frame.schema, str(tmp_path))
    assert keyed.read(spark, f"{tmp_path}/out").isEmpty()
    more = ticks_of([("A", T0 + 5, 7, 1), ("A", T0 + 2_000, 6, 1)]).withColumn("drain", F.lit(False))
    more.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    query(spark, frame.schema, str(tmp_path))
    made = keyed.bins_of(keyed.read(spark, f"{tmp_path}/out"))
    assert [(r.start_ts_ms - T0, float(r.open), float(r.close), r.trade_count) for r in made.orderBy("start_ts_ms").collect()] == [(0, 5.0, 7.0, 2), (400, 6.0, 6.0, 1)]


def test_state_survives_as_text():
    rng = np.random.default_rng(1)
    at = T0 + np.sort(rng.integers(0, 300_000, 500))
    price, size = rng.integers(1, 10**9, 500), rng.integers(0, 10**9, 500)
    whole = keyed.SymbolState(None, SETTINGS, emitted)
    rows, text = [], None
    for part in np.array_split(np.arange(500), 9):
        columns = [v[part] for v in (at, price, size, at, at, np.arange(500))]
        whole.add(*columns)
        whole.advance()
        state = keyed.SymbolState(text, SETTINGS, emitted)
        state.add(*columns)
        state.advance()
        rows, text = rows + state.out, state.text()
    assert rows == whole.out and text == whole.text()
    assert {r["kind"] for r in rows} == {keyed.BIN, keyed.BAR, keyed.MINUTE, keyed.FIVE}


def test_open_minute_is_given_early_and_again():
    state = keyed.SymbolState(None, SETTINGS, emitted)
    one = lambda t: [np.array([v], np.int64) for v in (t, 5_000_000, 1_000_000, t, t, 0)]
    for t in (T0, T0 + 3_000, T0 + 6_000):
        state.add(*one(t))
        state.advance()
    state.settle()
    early = state.out[-1]
    assert (early["kind"], early["final"], early["count"]) == (keyed.MINUTE, False, 2)
    state.add(*one(T0 + 70_000))
    state.advance()
    state.add(*one(T0 + 75_000))
    state.advance()
    final = [r for r in state.out if r["kind"] == keyed.MINUTE][-1]
    assert (final["final"], final["count"], final["minute_index"], final["start_ts_ms"]) == (True, 60, 0, early["start_ts_ms"])


def test_idle_symbol_settles_by_timer(spark, ticks_of, tmp_path):
    """A query that stays up gives the open minute once no tick came for a while."""
    frame = ticks_of([("A", T0, 5, 1), ("A", T0 + 9_000, 6, 1), ("A", T0 + 20_000, 6, 1)]).withColumn("drain", F.lit(False))
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    running = keyed.start(keyed.fold_stream(stream, SETTINGS, emitted, idle_ms=300), f"{tmp_path}/out", f"{tmp_path}/cp")
    try:
        for _ in range(40):
            running.awaitTermination(1)
            made = keyed.minutes_of(keyed.read(spark, f"{tmp_path}/out")) if list(tmp_path.glob("out/kind=*")) else None
            if made is not None and not made.isEmpty():
                break
    finally:
        running.stop()
    assert [(r.final, r.source_count) for r in made.collect()] == [(False, 8)]


@pytest.mark.parametrize("value,want", [(1_500_000, 2), (-1_500_000, -2), (499_999, 0), (500_000, 1), (10**30 + 1, 10**24)])
def test_rounding(value, want):
    assert keyed.rounded(value) == want
