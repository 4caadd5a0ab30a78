from __future__ import annotations

import gzip
import os
from collections import Counter

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickbars.operators import normalize, ordering
from tickbars.schemas import BAR_1S, BIN
from tickbars.sinks import messages
from tickbars.sources import raw, streams, ticks
from tickbars.streaming import stages

CSV = """# a comment
01/02/2025,14:30:00,10.5,10.4,10.6,100

01/02/2025,14:30:01,10.6,10.5
01/02/2025,14:30:02,n.a.,10.5,10.7,5
13/45/2025,14:30:03,1,1,1,1
01/02/2025,14:30:04,10.8,10.7,10.9,7,extra,fields
1/2/2025,4:3:5,11,,11.1,
"""


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "ticks.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_rules(spark, csv_file):
    good, bad = ticks.read_csv(spark, csv_file)
    rows = good.orderBy("arrival_seq").collect()
    numbers = [tuple(None if v is None else float(v) for v in (r.px, r.sz)) for r in rows]
    assert numbers == [(10.5, 100.0), (None, 5.0), (10.8, 7.0), (11.0, None)]
    assert rows[0].event_ts_ms == 1_735_828_200_000
    assert rows[0].source == "mock_api" and rows[0].symbol == "WDC"
    assert [r.line.split(",")[0] for r in bad.collect()] == ["13/45/2025"]


def test_csv_zone(spark, csv_file):
    good, _ = ticks.read_csv(spark, csv_file, symbol="AAPL", zone="America/New_York")
    first = good.orderBy("arrival_seq").first()
    assert (first.symbol, first.event_ts_ms) == ("AAPL", 1_735_828_200_000 + 5 * 3_600_000)


def test_line_order_over_files(spark, tmp_path):
    for name, start in (("a.txt", 0), ("b.txt", 5000)):
        (tmp_path / name).write_text("".join(f"{i}\n" for i in range(start, start + 5000)))
    rows = ticks.with_line_order(spark.read.text(str(tmp_path))).orderBy("arrival_seq").collect()
    assert [int(r.value) for r in rows] == list(range(10_000))
    assert len({r.arrival_seq for r in rows}) == 10_000


JSON = """{"symbol":"WDC","px":10.5,"sz":3,"event_ts":1735828200.25,"api_send_ts_ms":1735828200300,"source_event_ts_ms":7}
not json

{"px":"11.5","sz":"4","event_ts":"1735828201","api_send_ts_ms":"12.9","source_event_ts":1.5}
{"symbol":"","px":null,"event_ts":1735828202}
{"symbol":"X","px":1,"sz":2,"event_ts":3,"api_send_ts_ms":"soon","source":"s"}
"""


def test_ndjson_rules(spark, tmp_path):
    path = tmp_path / "ticks.ndjson"
    path.write_text(JSON)
    payloads, bad = ticks.read_ndjson(spark, str(path))
    assert [r.value for r in bad.collect()] == ["not json"]
    rows = normalize.normalize_ticks(payloads, default_symbol="DEF").orderBy("arrival_seq").collect()
    got = [
        (r.symbol, None if r.px is None else float(r.px), float(r.sz), r.event_ts_ms, r.api_send_ts_ms, r.source_event_ts_ms)
        for r in rows
    ]
    assert got == [
        ("WDC", 10.5, 3.0, 1_735_828_200_250, 1_735_828_200_300, 7),
        ("DEF", 11.5, 0.0, 1_735_828_201_000, 12, 1500),
        ("DEF", None, 0.0, 1_735_828_202_000, None, None),
        ("X", 1.0, 2.0, 3000, None, None),
    ]
    typed = normalize.normalize_ticks(payloads)
    assert normalize.valid_ticks(typed).count() == 3 and normalize.rejected_ticks(typed).count() == 1


def test_messages_round_trip(spark, bins_of, bars_of):
    bins = bins_of([("A", 1_735_828_200_000, 2.5, 4)])
    sent = messages.bin_messages(bins).withColumn("offset", F.lit(9)).withColumn("timestamp", F.timestamp_millis(F.lit(5)))
    (row,) = streams.decode(sent, BIN).collect()
    assert (row.bin_id, float(row.open), row.arrival_seq, row.record_ts_ms) == ("A-1735828200000", 2.5, 9, 5)
    bars = bars_of([("A", 1_735_828_200_000, 2.5, 4)])
    by_symbol = messages.bar_messages(bars, id_field="symbol")
    assert by_symbol.first().key == "A"
    assert messages.bar_messages(bars, id_field="nowhere").first().key == "A-1735828200000"
    bad = spark.createDataFrame([("k", ""), ("k", "{broken"), ("k", None)], "key STRING, value STRING")
    assert streams.decode(bad, BAR_1S).count() == 0


def test_jsonl_log(spark, tmp_path, bars_of):
    path = str(tmp_path / "log")
    messages.append_jsonl(bars_of([("A", 1000, 1, 1), ("A", 2000, 1, 1)]), path)
    messages.append_jsonl(bars_of([("A", 3000, 1, 1)]), path)
    assert streams.read_jsonl(spark, path, BAR_1S).count() == 3
    assert streams.read_jsonl(spark, path, BAR_1S, limit=2).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"bar_id": "x"}\n{oops\n')
    with pytest.raises((PySparkException, Py4JError)):
        streams.read_jsonl(spark, str(tmp_path / "bad.jsonl"), BAR_1S).collect()


def test_raw_landing(spark, tmp_path, bars_of):
    staged = str(tmp_path / "stage")
    messages.append_staged(bars_of([("A", 1000, 1.5, 1)]), staged)
    (tmp_path / "stage" / "more.json.gz").write_bytes(gzip.compress(b'\n{"symbol": "B", "nested": {"k": [1, 2]}}\n'))
    landed = raw.land_files(spark, staged)
    got = landed.select(
        raw.field("$.symbol", "string").alias("symbol"),
        raw.field("$.open", "double").alias("open"),
        raw.field("$.nested.k[1]", "bigint").alias("k"),
    ).orderBy("symbol")
    assert [tuple(r) for r in got.collect()] == [("A", 1.5, None), ("B", None, 2)]


def _uneven_files(folder):
    """Forty small files and a large one that can't be split; gives all lines in arrival order."""
    lines = []
    for i in range(40):
        own = [f"small {i} {k}" for k in range(5)]
        (folder / f"a{i:02d}.txt").write_text("\n".join(own) + "\n")
        lines += own
    own = [f"large {k}" for k in range(20_000)]
    (folder / "b.txt.gz").write_bytes(gzip.compress("\n".join(own).encode()))
    return lines + own


def test_uneven_files_give_dense_numbers_and_even_chunks(spark, tmp_path):
    lines = _uneven_files(tmp_path)
    rows = ticks.with_line_order(spark.read.text(str(tmp_path)))
    assert [(r.arrival_seq, r.value) for r in rows.orderBy("arrival_seq").collect()] == list(enumerate(lines))
    dense = rows.withColumn("chunk", ordering.dense_chunk("arrival_seq", 1_000))
    for chunked in (dense, ordering.with_even_chunk(rows, "arrival_seq", 1_000, "chunk")):
        sizes = [r["count"] for r in chunked.groupBy("chunk").count().collect()]
        assert max(sizes) <= 2_000 and sum(sizes) == len(lines)


def test_uneven_files_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = _uneven_files(tmp_path / "in")
    for i, path in enumerate(sorted((tmp_path / "in").iterdir())):
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    seen = []

    def handle(rows, batch):
        kept = rows.persist()
        placed = ticks.numbered(kept, "arrival_seq").persist()
        sizes = [r["count"] for r in placed.groupBy(ordering.dense_chunk("arrival_seq", 1_000).alias("c")).count().collect()]
        seen.append(([(r.arrival_seq, r.value) for r in placed.orderBy("arrival_seq").collect()], max(sizes)))
        kept.unpersist()

    stream = ticks.with_file_place(spark.readStream.text(str(tmp_path / "in")))
    stages.start(stream, handle, str(tmp_path / "cp"), until_idle=True).awaitTermination()
    [(got, largest)] = seen
    assert got == list(enumerate(lines)) and largest <= 2_000


def test_rows_without_files_are_numbered_without_gaps(spark):
    rows = spark.range(1_000).repartition(7).persist()
    got = ticks.numbered(rows, "arrival_seq")
    assert sorted(r.arrival_seq for r in got.collect()) == list(range(1_000))


@pytest.mark.parametrize("rows_per_chunk", [1, 7, 1_000, 10**6])
def test_even_chunks_of_leaping_numbers(spark, rows_per_chunk):
    """Crowded and empty stretches of an order column: no chunk is much too large, and none runs back."""
    low = spark.range(200).select((F.col("id") * (1 << 40)).alias("at"))
    crowd = spark.range(20_000).select((F.col("id") + (1 << 50)).alias("at"))
    rows = low.unionByName(crowd).unionByName(spark.createDataFrame([(-(2**60),), (2**60,)], "at long"))
    chunked = ordering.with_even_chunk(rows, "at", rows_per_chunk, "chunk").orderBy("at").collect()
    chunks = [r.chunk for r in chunked]
    assert chunks == sorted(chunks)
    assert max(Counter(chunks).values()) <= max(2 * rows_per_chunk, 60)
