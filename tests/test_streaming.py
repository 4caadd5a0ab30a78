from __future__ import annotations

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tickbars.operators import bars, bins, facts, gapfill, lateness, rollups
from tickbars.plans.feed import emitted_ms
from tickbars.session import shared_folder
from tickbars.settings import Settings
from tickbars.schemas import FACT_1S, FACT_60S, FACT_300S
from tickbars.sinks import tables, versioned
from tickbars.sources import ticks as tick_source
from tickbars.streaming import native, stages
from tickbars.streaming.classify import batch_folder_sink, split_stream, watermark_table

T0 = 1_735_822_800_000
LOAD = dt.datetime(2025, 1, 3)
FACTS = {"fact_1s": FACT_1S, "fact_60s": FACT_60S, "fact_300s": FACT_300S}


def _random_ticks(count, spread_ms):
    """Disordered arrivals; symbol B runs an hour ahead of A."""
    rng = random.Random(17)
    rows, now = [], T0
    for _ in range(count):
        now += rng.randint(0, spread_ms)
        symbol = rng.choice("AAB")
        ahead = 3_600_000 if symbol == "B" else 0
        rows.append((symbol, now + ahead - rng.choice([0, 0, 0, 200, 499, 500, 501, 2000]), rng.randint(1, 90), rng.randint(0, 5)))
    return rows


@pytest.fixture
def tick_files(spark, ticks_of, tmp_path):
    """Ticks in arrival order, written as one parquet file per slice."""
    frame = ticks_of(_random_ticks(300, 2000))
    for i, low in enumerate(range(0, 300, 100)):
        part = frame.where(F.col("arrival_seq").between(low, low + 99)).coalesce(1)
        part.write.parquet(str(tmp_path / "in" / f"slice={i}"))
    return frame, str(tmp_path / "in"), tmp_path


def _stream(spark, frame, path):
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{path}/*")


def _same(a, b, *columns):
    left, right = a.select(*columns), b.select(*columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def _read(spark, path):
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def test_split_by_per_symbol_watermark(spark, tick_files):
    frame, path, tmp = tick_files
    handler = split_stream(
        watermark_table(spark, str(tmp / "marks")),
        "arrival_seq",
        "event_ts_ms",
        batch_folder_sink(str(tmp / "good")),
        batch_folder_sink(str(tmp / "late")),
        rows_per_chunk=30,
    )
    stages.start(_stream(spark, frame, path), handler, str(tmp / "cp"), until_idle=True).awaitTermination()
    whole = lateness.with_lateness(frame, "arrival_seq", "event_ts_ms")
    late = lateness.late(whole)
    assert late.count() > 5
    _same(_read(spark, str(tmp / "good")), lateness.accepted(whole), "arrival_seq", "lateness_ms")
    _same(_read(spark, str(tmp / "late")), late, "arrival_seq", "lateness_ms")


def test_pipeline_drained_equals_batch(spark, tick_files):
    frame, path, tmp = tick_files
    root = str(tmp / "out")
    pipeline = stages.TickPipeline(spark, root, Settings(flush_minutes=2), ingest=emitted_ms(), load_ts=LOAD)
    query = stages.start(_stream(spark, frame, path), pipeline, str(tmp / "cp"), until_idle=True)
    query.awaitTermination()
    batches = 3
    before_drain = _read(spark, f"{root}/bins").count()
    pipeline.drain(batches, frame)

    accepted = lateness.accepted(lateness.with_lateness(frame, "arrival_seq", "event_ts_ms"))
    batch_bins = bins.fold_ticks(accepted, ingest=emitted_ms())
    stream_bins = _read(spark, f"{root}/bins")
    assert before_drain < stream_bins.count()
    _same(stream_bins, batch_bins, *batch_bins.columns)

    batch_bars = gapfill.filled_bars(batch_bins, ingest=emitted_ms())
    stream_bars = _read(spark, f"{root}/bars")
    _same(stream_bars, batch_bars, *batch_bars.columns)

    minutes = rollups.minute_bars(batch_bars)
    expected_60 = facts.fact_60s(rollups.minute_index(minutes, 2), LOAD)
    _same(_facts_of(spark, root, "fact_60s"), expected_60, *expected_60.columns)
    expected_300 = facts.fact_300s(rollups.counted_batches(minutes, 2), LOAD)
    assert expected_300.count() >= 4
    _same(_facts_of(spark, root, "fact_300s"), expected_300, *expected_300.columns)
    expected_1 = facts.fact_1s(batch_bars, LOAD)
    _same(_facts_of(spark, root, "fact_1s"), expected_1, *expected_1.columns)
    assert _read(spark, f"{root}/late_ticks").count() == frame.count() - accepted.count()

    # A batch that is run again leaves everything as it is.
    pipeline.drain(batches, frame)
    _same(_read(spark, f"{root}/bins"), batch_bins, *batch_bins.columns)
    _same(_facts_of(spark, root, "fact_1s"), expected_1, *expected_1.columns)


def test_idle_minutes_settle(spark, ticks_of, tmp_path):
    frame = ticks_of([("A", T0 + 1000, 1, 1), ("A", T0 + 5000, 1, 1), ("A", T0 + 9000, 1, 1)])
    clock = [T0 + 30_000]
    pipeline = stages.TickPipeline(spark, str(tmp_path), ingest=emitted_ms(), load_ts=LOAD, now_ms=lambda: clock[0])
    pipeline(frame, 0)
    assert _read(spark, f"{tmp_path}/minutes").count() == 0
    clock[0] = T0 + 100_000
    pipeline(frame.limit(0), 1)
    assert _read(spark, f"{tmp_path}/minutes").count() == 0
    clock[0] = T0 + 30_000 + 120_000
    pipeline(frame.limit(0), 2)
    assert _read(spark, f"{tmp_path}/minutes").count() == 1


def test_native_lane_in_step_with_batch(spark, ticks_of, tmp_path):
    frame = ticks_of([("A", T0 + i * 7, 1 + i % 5, 1) for i in range(600)])
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    out = native.bins(stream, ingest=emitted_ms())
    query = out.writeStream.format("memory").queryName("native_bins").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("native_bins")
    whole = bins.fold_ticks(frame.withColumn("lateness_ms", F.lit(0).cast("long")), ingest=emitted_ms())
    assert got.count() > 300
    assert got.select("bin_id", "open", "close", "volume").exceptAll(whole.select("bin_id", "open", "close", "volume")).count() == 0

    path = str(tmp_path / "bins")
    whole.unionByName(whole).write.parquet(path)
    bar_stream = native.bars(spark.readStream.schema(whole.schema).parquet(path), ingest=emitted_ms())
    bar_stream.writeStream.format("memory").queryName("native_bars").trigger(availableNow=True).start().awaitTermination()
    expected = bars.fold_bins(whole, ingest=emitted_ms()).select("bar_id", "volume", "bin_count")
    got_bars = spark.table("native_bars").select("bar_id", "volume", "bin_count")
    assert got_bars.count() >= 3 and got_bars.exceptAll(expected).count() == 0

    native.minutes(stream).writeStream.format("memory").queryName("native_minutes").trigger(
        availableNow=True
    ).start().awaitTermination()
    assert spark.table("native_minutes").columns[-1] == "start_ts_ms"


def test_csv_stream(spark, tmp_path):
    (tmp_path / "t.csv").write_text("01/02/2025,14:30:00,10.5,10.4,10.6,100\n#x\n01/02/2025,14:30:01,10.6\nbad,14:30:01,1,1,1,1\n")
    query = (
        tick_source.stream_csv(spark, str(tmp_path)).writeStream.format("memory").queryName("csv_ticks").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [float(r.px) for r in spark.table("csv_ticks").collect()] == [10.5]


def test_ndjson_stream_through_the_pipeline(spark, tmp_path):
    """Without a source order, rows are numbered in their micro-batch."""
    from tickbars.operators import normalize

    lines = [f'{{"symbol":"A","px":{1 + i % 3},"sz":1,"event_ts":{(T0 + i * 300) / 1000}}}' for i in range(20)] + ["oops"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.ndjson").write_text("\n".join(lines))
    stream = normalize.valid_ticks(normalize.normalize_ticks(tick_source.stream_ndjson(spark, str(tmp_path / "in"))))
    pipeline = stages.TickPipeline(spark, str(tmp_path / "out"), fill_gaps=False, ingest=emitted_ms(), load_ts=LOAD)
    stages.start(stream, pipeline, str(tmp_path / "cp"), until_idle=True).awaitTermination()
    pipeline.drain(1, _batch_like(spark, stream))
    got = _read(spark, f"{tmp_path}/out/bars")
    assert got.agg(F.sum("volume")).first()[0] == 20


def _batch_like(spark, stream):
    return spark.createDataFrame([], stream.schema)


def test_dimension_tables(spark, tmp_path):
    path, rows = str(tmp_path / "dim"), spark.range(3)
    tables.overwrite(rows.limit(1), path)
    tables.overwrite(rows.limit(2), path)
    tables.append(rows.limit(1), path)
    assert spark.read.parquet(path).count() == 3


def test_root_defaults_to_the_shared_folder(spark):
    """The setting is fixed at launch, so a stand-in session carries it here."""
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: "hdfs://shared/"))
    assert shared_folder(named, "tick-pipeline") == "hdfs://shared/tick-pipeline"
    if not spark.conf.get("spark.checkpoint.dir", ""):
        with pytest.raises(ValueError):
            stages.TickPipeline(spark)


def _facts_of(spark, root, name):
    schema = facts.with_trade_hour(spark.createDataFrame([], FACTS[name])).schema
    return versioned.read(spark, f"{root}/{name}", schema)


def test_settled_minute_is_one_row(spark, ticks_of, tmp_path):
    """A minute given early grows with each batch and stays one row; a repeated batch changes nothing."""
    rows = [("A", T0 + 1000, 1, 10), ("A", T0 + 12_000, 2, 20), ("A", T0 + 24_000, 3, 3), ("A", T0 + 36_000, 4, 2), ("A", T0 + 40_000, 4, 0)]
    frame = ticks_of(rows)
    clock = [T0 + 100_000]
    root = str(tmp_path)
    pipeline = stages.TickPipeline(spark, root, Settings(flush_minutes=1), False, ingest=emitted_ms(), load_ts=LOAD, now_ms=lambda: clock[0])
    for batch, (low, high) in enumerate([(0, 1), (2, 2), (3, 4)]):
        pipeline(frame.where(F.col("arrival_seq").between(low, high)), batch)
        clock[0] += 150_000
    got = _facts_of(spark, root, "fact_60s").collect()
    assert len(got) == 1 and got[0].minute_index is None
    pipeline.drain(3, frame)
    pipeline.drain(3, frame)
    got = _facts_of(spark, root, "fact_60s").collect()
    assert [(float(r.volume), r.minute_index, r.source_count) for r in got] == [(35.0, 0, 5)]
    five = _facts_of(spark, root, "fact_300s").collect()
    assert [float(r.volume) for r in five] == [35.0]


def test_clock_is_read_once_per_batch(spark, ticks_of, tmp_path):
    clock = [T0 + 200_000]
    pipeline = stages.TickPipeline(spark, str(tmp_path), ingest=emitted_ms(), load_ts=LOAD, now_ms=lambda: clock[0])
    assert pipeline._settle_before(0) == T0 + 198_000
    clock[0] += 500_000
    assert pipeline._settle_before(0) == T0 + 198_000
    fresh = stages.TickPipeline(spark, str(tmp_path), ingest=emitted_ms(), load_ts=LOAD, now_ms=lambda: clock[0])
    assert fresh._settle_before(0) == T0 + 198_000
    assert fresh._settle_before(1) == T0 + 698_000
    clock[0] += 10
    assert fresh._settle_before(2) is None


def test_bins_topic_drained_equals_batch(spark, tick_files):
    """Bins delivered twice and out of order become the bars of the batch operators."""
    frame, _, tmp = tick_files
    accepted = lateness.accepted(lateness.with_lateness(frame, "arrival_seq", "event_ts_ms"))
    made = bins.fold_ticks(accepted, ingest=emitted_ms())
    late = F.expr("(start_ts_ms div 10) * 7919 % 9000")
    arriving = made.withColumn("arrival_seq", (F.col("end_ts_ms") + late) * 2000 + F.crc32("bin_id") % 1000 * 2)
    twice = arriving.unionByName(arriving.withColumn("arrival_seq", F.col("arrival_seq") + 1)).persist()
    root = str(tmp / "bins_out")
    pipeline = stages.BinPipeline(spark, root, Settings(flush_minutes=2), ingest=emitted_ms(), load_ts=LOAD)
    cuts = [r[0] for r in twice.select("arrival_seq").orderBy("arrival_seq").collect()]
    borders = [cuts[0], cuts[len(cuts) // 3], cuts[2 * len(cuts) // 3], cuts[-1] + 1]
    for batch, (low, high) in enumerate(zip(borders, borders[1:])):
        pipeline(twice.where((F.col("arrival_seq") >= low) & (F.col("arrival_seq") < high)), batch)
    pipeline.drain(3, twice)

    judged = lateness.with_lateness(twice, "arrival_seq", "end_ts_ms")
    good = bins.dedupe(lateness.accepted(judged))
    assert lateness.late(judged).count() > 5
    expected = bars.fold_bins(good, ingest=emitted_ms())
    stream_bars = _read(spark, f"{root}/bars")
    _same(stream_bars, expected, "bar_id", "open", "close", "volume", "notional", "bin_count")
    assert _read(spark, f"{root}/late_bins").count() == lateness.late(judged).count()
    minutes = rollups.minute_bars(expected)
    expected_60 = facts.fact_60s(rollups.minute_index(minutes, 2), LOAD)
    _same(_facts_of(spark, root, "fact_60s"), expected_60, *expected_60.columns)
    sent = spark.read.option("recursiveFileLookup", True).json(f"{root}/messages/bars")
    _same(sent, expected.select(F.col("bar_id").alias("key")), "key")


def test_bars_topic_drained_equals_batch(spark, bars_of, tmp_path):
    """Bars with holes and copies become facts; a second that comes late joins its flushed minute and its five minutes."""
    made = bars_of([("A", T0 + i * 1000, 1 + i % 7, 1 + i % 3) for i in range(0, 400, 3)])
    thin = made.withColumn("high", F.when(F.col("start_ts_ms") % 2000 == 0, F.col("high"))).withColumn("arrival_seq", F.col("start_ts_ms"))
    root = str(tmp_path)
    pipeline = stages.BarPipeline(spark, root, Settings(flush_minutes=2), ingest=F.lit(T0).cast("long"), load_ts=LOAD)
    held = F.col("start_ts_ms") == T0 + 30_000
    pipeline(thin.where((F.col("start_ts_ms") < T0 + 200_000) & ~held), 0)
    pipeline(thin.where(F.col("start_ts_ms") >= T0 + 150_000), 1)
    pipeline(thin.where(held), 2)
    pipeline.drain(3, thin)
    minutes = rollups.minute_bars(rollups.with_defaults(made))
    expected_60 = facts.fact_60s(rollups.minute_index(minutes, 2), LOAD)
    _same(_facts_of(spark, root, "fact_60s"), expected_60, "bar_id", "open", "close", "volume", "notional", "source_count", "minute_index")
    expected_300 = facts.fact_300s(rollups.counted_batches(minutes, 2), LOAD)
    assert expected_300.count() == 3
    _same(_facts_of(spark, root, "fact_300s"), expected_300, "bar_id", "open", "close", "volume", "notional", "minute_count", "source_count")
    assert _facts_of(spark, root, "fact_1s").count() == made.count()


def test_files_of_a_batch_arrive_by_time(spark, tmp_path):
    """An early short file and a later long one in one micro-batch: Spark reads the long one first."""
    import os

    folder = tmp_path / "in"
    folder.mkdir()
    line = '{{"symbol":"A","px":1,"sz":1,"event_ts":{}}}'.format
    (folder / "z_early.ndjson").write_text("\n".join(line((T0 + i) / 1000) for i in range(5)))
    (folder / "a_later.ndjson").write_text("\n".join(line((T0 + 60_000 + i) / 1000) for i in range(500)))
    os.utime(folder / "z_early.ndjson", (1_700_000_000, 1_700_000_000))
    os.utime(folder / "a_later.ndjson", (1_700_000_100, 1_700_000_100))
    from tickbars.operators import normalize

    stream = normalize.valid_ticks(normalize.normalize_ticks(tick_source.stream_ndjson(spark, str(folder))))
    pipeline = stages.TickPipeline(spark, str(tmp_path / "out"), fill_gaps=False, ingest=emitted_ms(), load_ts=LOAD)
    stages.start(stream, pipeline, str(tmp_path / "cp"), until_idle=True).awaitTermination()
    assert _read(spark, f"{tmp_path}/out/late_ticks").count() == 0


def test_old_state_does_not_pile_up(spark, ticks_of, tmp_path):
    frame = ticks_of([("A", T0 + i * 400, 1, 1) for i in range(30)])
    pipeline = stages.TickPipeline(spark, str(tmp_path), ingest=emitted_ms(), load_ts=LOAD)
    for batch in range(6):
        pipeline(frame.where(F.col("arrival_seq").between(batch * 5, batch * 5 + 4)), batch)
    for name in ("watermarks", "open_rows", "open_pieces", "open_bars", "open_minutes", "last_bins"):
        assert len(list((tmp_path / "state" / name).glob("slot=*"))) == 4
