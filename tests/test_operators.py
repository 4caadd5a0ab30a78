from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.operators import (
    bars,
    contracts,
    dims,
    facts,
    merge,
    normalize,
    ordering,
    quality,
    quotes,
    replay,
    rollups,
    serving,
)
from tickbars.plans import marts

T0 = 1_735_822_800_000
LOAD = dt.datetime(2025, 1, 3)


def test_scalars(spark):
    frame = spark.createDataFrame([(-1, "A", None, "1e3"), (1005, "A", 1005.0, "nan"), (999, "A", 999.5, " 12 ")], "t BIGINT, s STRING, v DOUBLE, n STRING")
    got = frame.select(
        x.floor_ms("t", 10), x.series_id("s", "t"), x.duration_text("v"), x.number("n"), x.floor_ms(F.col("t"), 1000)
    ).collect()
    assert [tuple(r) for r in got] == [
        (-10, "A-%013d" % -1, "n/a", 1000.0, -1000),
        (1000, "A-0000000001005", "1.00 s", None, 1000),
        (990, "A-0000000000999", "1000 ms", 12.0, 0),
    ]
    assert f"{1005 / 1000:.2f} s" == "1.00 s" and f"{999.5:.0f} ms" == "1000 ms"
    row = spark.sql("SELECT '1d' a, '0x1p3' b, 'Infinity' c, '-.5' d, '5.' e, '' f, '1_0' g")
    assert tuple(row.select(*[x.number(c) for c in "abcdefg"]).first()) == (None, None, None, -0.5, 5.0, None, None)
    assert x.split_symbols(" aapl, ,msft ") == ["AAPL", "MSFT"]
    clamped = spark.range(1).select(x.clamp(F.lit(5.0), 10, 30), x.clamp(F.lit(50.0), 10, 30)).first()
    assert tuple(clamped) == (10.0, 30.0)


def test_market_open_overrides():
    assert normalize.clock_seconds(None, normalize.OPEN_UTC) == 14 * 3600 + 30 * 60
    assert normalize.clock_seconds("13", normalize.OPEN_UTC) == 13 * 3600
    assert normalize.clock_seconds("9:15:30", normalize.OPEN_UTC) == 9 * 3600 + 15 * 60 + 30
    assert normalize.clock_seconds("nine", normalize.OPEN_LOCAL) == 9 * 3600 + 30 * 60


def test_market_open_rows(ticks_of):
    day = 1_735_776_000_000
    frame = ticks_of([("A", day + 52_199_999, 1, 1), ("A", day + 52_200_000, 1, 1)])
    assert [r.arrival_seq for r in normalize.market_open_utc(frame).collect()] == [1]
    assert normalize.market_open_local(frame, "America/New_York").count() == 1


def test_schedule_chunks_agree_with_one_pass(ticks_of):
    rng = random.Random(11)
    rows = [(rng.choice("AAB"), T0 + rng.randint(0, 50_000), 1, 1) for _ in range(300)]
    frame = ticks_of(rows)
    whole = replay.schedule(frame, 2.0, 1.5).select("arrival_seq", "emit_offset_us")
    cut = replay.schedule(frame, 2.0, 1.5, rows_per_chunk=25).select("arrival_seq", "emit_offset_us")
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0
    last, total, expected = {}, {}, {}
    for i, (s, t, *_r) in enumerate(rows):
        step = max(t - last[s], 0) / 2.0 if s in last else 0
        last[s] = t
        total[s] = total.get(s, 0) + min(step * 1000, 1_500_000)
        expected[i] = round(total[s])
    assert {r.arrival_seq: r.emit_offset_us for r in cut.collect()} == expected
    with pytest.raises(ValueError):
        replay.schedule(frame, speed=0)


def test_rebase(ticks_of):
    got = replay.rebase(ticks_of([("A", 500, 1, 1), ("A", 400, 1, 1)]), 10_000).orderBy("arrival_seq").collect()
    assert [(r.event_ts_ms, r.source_event_ts_ms) for r in got] == [(10_000, 500), (9_900, 400)]


def test_first_n(ticks_of):
    frame = ticks_of([("A", i, 1, 1) for i in range(10)])
    assert [r.arrival_seq for r in replay.first_n(frame, 3).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        replay.first_n(frame, 0)


def _days(spark, days):
    return spark.createDataFrame([(dt.datetime(2025, 1, d, 12),) for d in days], "ts TIMESTAMP")


def test_first_full_week(spark):
    rows = _days(spark, [6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 18, 17])
    got = sorted(r.ts.day for r in replay.first_full_week(rows, "ts").collect())
    assert got == [13, 14, 15, 16, 17, 17]
    with pytest.raises((PySparkException, Py4JError)):
        replay.first_full_week(_days(spark, [6, 7]), "ts").collect()


def test_loose_records_to_facts(spark):
    fields = [f for f in "bar_id symbol start_ts_ms end_ts_ms open high low close volume notional vwap bin_count max_lateness_ms ingest_ts_ms".split()]
    records = spark.createDataFrame(
        [
            ("x", "A", "1000.9", "2000", "5", "", None, "oops", "true", None, None, "3.7", None, "0"),
            ("y", "A", "0", "2000", *[None] * 10),
            (None, "A", "1000", "2000", *[None] * 10),
            ("z", None, "1000", "2000", *[None] * 10),
        ],
        ", ".join(f"{f} STRING" for f in fields),
    )
    (row,) = facts.fact_1s_from_records(records, F.lit(9000).cast("long"), LOAD).collect()
    assert (row.open, row.high, row.low, row.close, row.volume, row.notional, row.vwap) == (5, 5, 5, 5, 1, 0, 5)
    assert (row.bin_count, row.max_lateness_ms) == (3, 0)
    assert row.start_ts == dt.datetime(1970, 1, 1, 0, 0, 1) and row.ingest_ts == dt.datetime(1970, 1, 1, 0, 0, 9)
    wide = spark.createDataFrame([(Decimal("1"),), (Decimal("1e13"),)], "open DECIMAL(30,6)")
    fits, rest = facts.split_by_fit(wide)
    assert (fits.count(), rest.count()) == (1, 1)


def test_calendar_of_2025(spark):
    calendar = dims.dim_calendar(spark, load_ts=LOAD)
    row = calendar.agg(
        F.count("*").alias("n"), F.count_if("is_trading_session").alias("open"), F.max("calendar_minute").alias("last")
    ).first()
    assert (row.n, row.open, row.last) == (525_600, 101_790, dt.datetime(2025, 12, 31, 23, 59))
    sample = calendar.where("trade_date = '2025-01-03' AND hour IN (13, 19, 20)").orderBy("calendar_minute").collect()
    labels = {(r.hour, r.minute): r.session_name for r in sample}
    assert (labels[13, 29], labels[13, 30], labels[19, 59], labels[20, 0]) == ("OFF", "REG", "REG", "OFF")
    with pytest.raises(ValueError):
        dims.dim_calendar(spark, dt.date(2025, 1, 2), dt.date(2025, 1, 1))


def _minute_facts(bars_of, closes, volumes=None, symbol="A", gap=lambda i: i):
    volumes = volumes or [1] * len(closes)
    rows = [(symbol, T0 + gap(i) * 60_000, c, v) for i, (c, v) in enumerate(zip(closes, volumes))]
    return facts.fact_60s(rollups.minute_bars(bars_of(rows)), LOAD)


def test_rolling_features_against_statistics(bars_of):
    rng = random.Random(5)
    closes = [Decimal(rng.randint(100, 99_999)) / 100 for _ in range(150)]
    volumes = [rng.randint(0, 9) for _ in closes]
    frame = _minute_facts(bars_of, closes, volumes, gap=lambda i: i * 37)
    got = marts.price_60s_features(frame).orderBy("start_ts").collect()
    assert len(got) == 150
    for i, row in enumerate(got):
        window = closes[max(0, i - 59) : i + 1]
        assert row.ma_60 == pytest.approx(float(sum(window) / len(window)), rel=1e-12)
        if i == 0:
            assert row.std_60 is None
        else:
            assert row.std_60 == pytest.approx(float(statistics.stdev(window)), rel=1e-12)
        volume = sum(volumes[max(0, i - 59) : i + 1])
        notional = sum(c * v for c, v in zip(closes[max(0, i - 59) : i + 1], volumes[max(0, i - 59) : i + 1]))
        assert row.rolling_vwap == (pytest.approx(float(notional) / volume, rel=1e-12) if volume else None)


def test_rolling_sums_across_blocks(spark):
    frame = spark.range(1, 1001).select(F.lit("A").alias("s"), "id")
    got = ordering.rolling_sums(frame, ["s"], "id", 60, {"total": F.col("id")}, block=100).orderBy("id").collect()
    assert [r.total for r in got] == [sum(range(max(1, i - 59), i + 1)) for i in range(1, 1001)]
    with pytest.raises(ValueError):
        ordering.rolling_sums(frame, ["s"], "id", 60, {"total": F.col("id")}, block=10)


def test_views(spark, bars_of):
    minutes = _minute_facts(bars_of, [2, 4, 6], [1, 0, 3])
    five = facts.fact_300s(
        rollups.aligned_five_minutes(rollups.minute_bars(bars_of([("A", T0, 2, 1), ("Q", T0, 0, 1), ("A", T0 + 900_000, 3, 1)]))),
        LOAD,
    )
    as_of = dt.datetime(2025, 1, 2, 13, 15)
    names = marts.register_views(spark, minutes, five, dims.dim_symbol(spark, LOAD), as_of)
    assert len(names) == 7
    vwap = spark.sql("SELECT * FROM vw_session_vwap").first()
    assert (vwap.session_vwap, vwap.session_volume) == (5.0, 4)
    movers = spark.sql("SELECT * FROM vw_top_movers_15m").collect()
    assert [(m.symbol, m.pct_change) for m in movers] == [("A", 0.5), ("Q", None)]
    assert marts.top_movers(five, as_of, limit=1).count() == 1
    price = spark.sql("SELECT * FROM vw_price_60s").first()
    assert price.company_name is None and price.symbol == "A"
    metrics = spark.sql("SELECT * FROM vw_pipeline_minute_metrics ORDER BY minute_ts").first()
    assert (metrics.minute_ts, metrics.latency_ms) == (dt.datetime(2025, 1, 2, 13, 1), 1500 - 60_000)


def test_session_vwap_without_volume(bars_of):
    (row,) = marts.session_vwap(_minute_facts(bars_of, [2], [0])).collect()
    assert row.session_vwap is None and row.session_volume == 0


def test_reconcile_finds_exactly_the_seeded_faults(bars_of):
    good = bars_of([("A", T0 + i * 1000, 5, 2) for i in range(6)])
    changed = F.when(F.col("start_ts_ms") == T0 + 2000, F.col("close") + Decimal("0.5")).otherwise(F.col("close"))
    bad = (
        good.where(F.col("start_ts_ms") != T0)
        .withColumn("close", changed)
        .unionByName(bars_of([("A", T0 + 60_000, 5, 2)]))
    )
    found = {(r.bar_id[-13:], r.kind, r.field) for r in quality.reconcile(good, bad).collect()}
    assert found == {
        (f"{T0:013d}", "missing", None),
        (f"{T0 + 60_000:013d}", "extra", None),
        (f"{T0 + 2000:013d}", "mismatch", "close"),
    }
    assert tuple(quality.summary(good, bad).first()) == (6, 6, 1, 1, 1, False)
    assert tuple(quality.summary(good, good).first()) == (6, 6, 0, 0, 0, True)
    near = good.withColumn("close", (F.col("close") + Decimal("0.000001")).cast("decimal(18,6)"))
    assert quality.reconcile(good, near, tolerance=2e-6).count() == 0
    assert quality.all_examples(quality.reconcile(good, bad)).count() == 3


@pytest.mark.parametrize("values", [[], [7], list(range(19)), list(range(20)), list(range(21)), list(range(100)), [-5, 3], [10**6, 1, 70_000, 70_001, 5] * 4, [2**62, 2**48 - 1, 2**48, 2**32 + 5] * 7, list(range(30)) + [1_735_822_800_000]])
def test_latency_rank(spark, values):
    rows = spark.createDataFrame([(0, v) for v in values], "end_ts_ms BIGINT, ingest_ts_ms BIGINT")
    sorted_values = sorted(max(v, 0) for v in values)
    expected = (0, 0, 0)
    if values:
        expected = (len(values), sorted_values[min(len(values) - 1, int(len(values) * 0.95))], sorted_values[-1])
    assert tuple(quality.latency_stats(rows).first()) == expected


def test_contract_rules(bins_of):
    good = bins_of([("A", T0, 5, 1)])
    assert contracts.bin_violations(good).count() == 0
    spoiled = {
        "bin_id": (F.lit("a-1"), "bin_id:pattern"),
        "volume": (F.lit(-1).cast("decimal(18,6)"), "volume:minimum"),
        "window_ms": (F.lit(20).cast("long"), "window_ms:const"),
        "trade_count": (F.lit(0).cast("long"), "trade_count:minimum"),
        "api_send_ts_ms": (F.lit(None).cast("long"), "api_send_ts_ms:required"),
        "source": (F.lit("x"), "source:enum"),
        "symbol": (F.lit(""), "symbol:min_length"),
    }
    for name, (value, rule) in spoiled.items():
        bad = good.withColumn(name, value)
        assert [r.rule for r in contracts.bin_violations(bad).collect()] == [rule]
        valid, invalid = contracts.split_valid(bad, contracts.bin_rules())
        assert (valid.count(), invalid.count()) == (0, 1)
    filler = good.withColumn("trade_count", F.lit(0).cast("long")).withColumn("api_send_ts_ms", F.lit(None).cast("long"))
    assert contracts.bin_violations(filler).count() == 2
    assert contracts.bin_violations(filler, fillers=True).count() == 0


def test_bar_contract(bars_of):
    good = bars_of([("A", T0, 5, 1)])
    assert contracts.bar_violations(good).count() == 0
    assert [r.rule for r in contracts.bar_violations(good.withColumn("vwap", F.lit(None).cast("double"))).collect()] == ["vwap:required"]


def test_serving(bars_of):
    frame = bars_of([("A", T0 + i * 1000, 5, i % 2) for i in range(10)] + [("B", T0 - 86_400_000, 1, 1), ("B", T0, 2, 1)])
    assert serving.latest_n(frame, 3).where("symbol = 'A'").agg(F.min("start_ts_ms")).first()[0] == T0 + 7000
    assert serving.latest_n(frame, 2).where("symbol = 'B'").count() == 2
    newest = {r.symbol: (r.start_ts_ms, r.close) for r in serving.latest_bar(frame).collect()}
    assert newest == {"A": (T0 + 9000, 5), "B": (T0, 2)}
    assert serving.last_seconds(frame, 4).where("symbol = 'A'").count() == 5
    gaps = {r.symbol: r.avg_real_gap_ms for r in serving.average_real_gap(frame).collect()}
    assert gaps == {"A": 2000.0, "B": 86_400_000.0}
    steps = serving.start_gaps(frame).groupBy("symbol").agg(F.avg("gap_ms").alias("m")).collect()
    assert {r.symbol: r.m for r in steps} == gaps
    assert serving.average_real_gap(frame.where("volume = 0")).first().avg_real_gap_ms == 0.0
    assert [r.symbol for r in serving.distinct_symbols(frame).collect()] == ["A", "B"]
    assert serving.snapshot(frame).columns[:2] == ["symbol", "start_time"]


def test_gap_metrics(bars_of, spark):
    frame = bars_of([("A", T0 + i * 1000, 5, 1) for i in range(5)])
    frame = frame.withColumn("received_ts_ms", F.col("ingest_ts_ms") + F.expr("(start_ts_ms div 1000) % 7"))
    frame = frame.withColumn("record_ts_ms", F.lit(None).cast("long"))
    newest = F.col("start_ts_ms") == T0 + 4000
    frame = frame.withColumn("api_send_ts_ms", F.when(~newest, F.col("api_send_ts_ms")))
    row = serving.gap_metrics(frame, T0 + 10_000, ("start_ts_ms",), window=2, per_symbol=3).first()
    offset = [(T0 // 1000 + i) % 7 for i in range(5)]
    assert row.last_api_gap_ms is None and row.last_broker_gap_ms == 0.0 and row.avg_broker_gap_ms == 0.0
    assert row.avg_api_gap_ms == 1480 + (offset[2] + offset[3]) / 2
    assert row.last_producer_gap_ms == offset[4] and row.avg_producer_gap_ms == (offset[3] + offset[4]) / 2
    assert (row.backlog_ms, row.bars_cached, row.last_update_ts_ms) == (5000.0, 3.0, T0 + 5500 + offset[4])
    empty = serving.gap_metrics(frame.limit(0), 5, ("start_ts_ms",)).first()
    assert (empty.last_api_gap_ms, empty.avg_api_gap_ms, empty.backlog_ms, empty.bars_cached) == (None, 0.0, 5.0, 0.0)


def test_live_rows(spark):
    frame = spark.createDataFrame(
        [(0, "A", 1.5, None, float("inf"), 2.0, None, 1.5, 9), (1, None, 2.25, 1.0, 3.0, None, 7.0, None, 9)],
        "arrival_seq BIGINT, symbol STRING, px DOUBLE, bid DOUBLE, ask DOUBLE, sz DOUBLE, size DOUBLE, event_ts DOUBLE, api_send_ts_ms BIGINT",
    ).withColumn("source", F.lit(None).cast("string"))
    new, old = serving.live_rows(frame).orderBy(F.desc("arrival_seq")).collect()
    assert (new.symbol, new.px, new.size, new.time_ms, new.source) == ("–", "2.2500", "7.00", 9.0, "mock_api")
    assert (old.bid, old.ask, old.size, old.time_ms) == ("–", "–", "2.00", 1500.0)
    assert serving.live_series(frame, 1).first().px == 2.25
    stats = serving.live_stats(frame).first()
    assert (stats.ticks, stats.last_symbol, stats.last_price) == (2, "–", "2.2500")


def _quotes(spark, rows):
    return spark.createDataFrame(
        rows, "quote_id BIGINT, symbol STRING, px DOUBLE, bid DOUBLE, ask DOUBLE, sz DOUBLE, event_ts_ms BIGINT, source STRING, api_send_ts_ms BIGINT"
    )


def test_quote_size_skips_zero(spark):
    raw = spark.createDataFrame(
        [(1, "A", 1.0, 1.0, 1.0, 0.0, 0.0, 5.0, 9), (2, "A", 1.0, 1.0, 1.0, 0.0, None, 0.0, 9)],
        "quote_id BIGINT, symbol STRING, last_price DOUBLE, bid DOUBLE, ask DOUBLE, last_size DOUBLE, bid_size DOUBLE, ask_size DOUBLE, quote_ts_ms BIGINT",
    )
    assert [r.sz for r in quotes.normalize_quotes(raw).orderBy("quote_id").collect()] == [5.0, None]


def test_backfill(spark, bars_of):
    day = 86_400_000
    minutes = rollups.minute_bars(bars_of([("A", T0, 10, 3), ("A", T0 + 60_000, 11, 4)]))
    rows = [
        (1, "A", None, None, 9.0, None, T0 + 61_000, "live", 0),
        (2, "A", None, None, None, 5.0, T0 + 62_000, "live", 0),
        (3, "A", 7.0, None, None, None, T0 + 63_000, "live", 0),
        (4, "A", None, None, None, None, T0 - 5, "live", 0),
        (5, "A", None, 1.0, 2.0, 3.0, T0 + 3 * day, "live", 0),
        (6, "Z", None, None, None, None, T0 + 61_000, "live", 0),
    ]
    got = {r.quote_id: tuple(r)[2:8] for r in quotes.backfill(_quotes(spark, rows), minutes).collect()}
    history = quotes.HISTORY_SOURCE
    assert got[1] == (11.0, 11.0, 9.0, 4.0, T0 + 60_000, history)
    assert got[2] == (11.0, 11.0, 9.0, 5.0, T0 + 62_000, "live")
    assert got[3] == (7.0, None, None, None, T0 + 63_000, "live")
    assert got[4] == (None, None, None, None, T0 - 5, "live")
    assert got[5] == (11.0, 1.0, 2.0, 3.0, T0 + 60_000, history)
    assert got[6] == (None, None, None, None, T0 + 61_000, "live")
    each = {r.quote_id: tuple(r)[2:8] for r in quotes.backfill(_quotes(spark, rows), minutes, refetch_ms=0).collect()}
    assert each[2] == (11.0, 11.0, 11.0, 5.0, T0 + 60_000, history) and each[1] == got[1] and each[4] == got[4]


def _fetches(asks, wait, longest):
    """The fold over all asks of a symbol, in order."""
    out, state = [], {}
    for symbol, at, quote, found in sorted(asks, key=lambda a: (a[0], a[1])):
        own = state.setdefault(symbol, {"wait": wait, "next": -(10**18)})
        if at < own["next"]:
            continue
        own["wait"] = wait if found else min(2 * own["wait"], longest)
        own["next"] = at + own["wait"]
        if found:
            out.append((symbol, at, quote))
    return sorted(out)


@pytest.mark.parametrize("wait,longest", [(30_000, 300_000), (7, 50), (300_000, 300_000), (1_000, 500)])
def test_fetches_equal_the_fold(spark, wait, longest):
    """Crowded minutes, empty hours and days, chains over midnight, and hours that a chain leaps over."""
    rng = random.Random(wait)
    asks, at = [], {s: T0 for s in "ABCD"}
    for k in range(6_000):
        symbol = rng.choice("AABCD")
        step = {"A": 3_000, "B": rng.choice([10, 200_000]), "C": rng.choice([1, 5, 40_000_000]), "D": 290_000}[symbol]
        at[symbol] += rng.randint(1, step)
        asks.append((symbol, at[symbol], k, rng.random() < {"A": 0.5, "B": 0.02, "C": 0.3, "D": 0.0}[symbol]))
    hour = 3_600_000
    start = T0 - T0 % hour
    asks += [("E", start + k * hour + off, 10_000 + k, k % 3 == 0) for k, off in enumerate([hour - 5, 100_000, 294_994, 1, hour - 1, 0])]
    frame = spark.createDataFrame(asks, "symbol STRING, event_ts_ms BIGINT, quote_id BIGINT, found BOOLEAN")
    got = quotes.history_fetches(frame, wait, longest)
    assert sorted((r.symbol, r.lead_ts_ms, r.lead_id) for r in got.collect()) == _fetches(asks, wait, longest)


def test_cached_values_are_carried_over_midnight(spark, bars_of):
    """A wait that began before midnight holds after it, and the values of the last fetch are still used."""
    day = 86_400_000
    midnight = T0 - T0 % day + day
    minutes = rollups.minute_bars(bars_of([("A", midnight - 60_000, 10, 3), ("A", midnight, 12, 4)]))
    rows = [(1, "A", None, None, None, None, midnight - 10_000, "live", 0), (2, "A", None, None, None, None, midnight + 5_000, "live", 0)]
    got = {r.quote_id: r for r in quotes.backfill(_quotes(spark, rows), minutes).collect()}
    assert (got[1].px, got[1].source) == (10.0, quotes.HISTORY_SOURCE)
    assert (got[2].px, got[2].source, got[2].event_ts_ms) == (10.0, "live", midnight + 5_000)


def test_merge_replaces_and_inserts(bars_of):
    old = bars_of([("A", T0, 1, 1), ("A", T0 + 1000, 2, 1)])
    new = bars_of([("A", T0 + 1000, 9, 1), ("A", T0 + 2000, 3, 1)])
    merged = merge.merge_by_key(old, new)
    assert sorted(float(r.close) for r in merged.collect()) == [1.0, 3.0, 9.0]
    again = merge.merge_by_key(merged, new)
    assert again.exceptAll(merged).count() == 0 and merged.exceptAll(again).count() == 0
    copies = new.withColumn("n", F.lit(1)).unionByName(new.withColumn("close", F.lit(8).cast("decimal(18,6)")).withColumn("n", F.lit(2)))
    assert sorted(float(r.close) for r in merge.merge_by_key(old, copies, order="n").collect()) == [1.0, 8.0, 8.0]
