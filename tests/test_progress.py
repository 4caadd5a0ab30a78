"""Progress of streaming queries as a table."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tickbars.operators import serving
from tickbars.streaming import progress

T0 = 1_735_822_800_000


def test_file_stream_leaves_its_progress(spark, bars_of, tmp_path):
    """Six files, one a batch: every batch has a row, and gap metrics carry the newest."""
    for k in range(6):
        bars_of([("A", T0 + 1000 * k, 1, 1)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    listener = progress.ProgressTable(spark, str(tmp_path / "progress"), every=4)
    spark.streams.addListener(listener)
    try:
        like = bars_of([("A", T0, 1, 1)])
        stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        sink = stream.writeStream.queryName("bars_in").format("parquet").option("path", f"{tmp_path}/out")
        query = sink.option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
        query.awaitTermination(30)
        # Events reach a listener on a thread of its own.
        for _ in range(100):
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            listener.flush()
            done = progress.read(spark, str(tmp_path / "progress")).where("input_rows > 0").count() if (tmp_path / "progress").exists() else 0
            if done >= 6:
                break
    finally:
        spark.streams.removeListener(listener)
    rows = progress.read(spark, str(tmp_path / "progress")).where("input_rows > 0").orderBy("batch").collect()
    assert [(r.query, r.batch, r.input_rows) for r in rows] == [("bars_in", k, 1) for k in range(6)]
    assert [r.behind for r in rows] == [None] * 6 and all(r.batch_ms > 0 for r in rows)
    table = progress.read(spark, str(tmp_path / "progress"))
    [newest] = progress.latest(table).collect()
    assert newest.query == "bars_in" and newest.batch == max(r.batch for r in table.collect())
    bars = like.selectExpr("*", f"{T0 + 2000}L AS received_ts_ms", f"{T0 + 1900}L AS record_ts_ms")
    metrics = serving.gap_metrics(bars, T0 + 5000)
    [row] = progress.with_backlog(metrics, table).collect()
    assert (row.queries, row.behind, row.slowest_batch_ms) == (1, None, newest.batch_ms)
    assert row.backlog_ms == metrics.first().backlog_ms == 4000.0
    [row] = progress.with_backlog(metrics, table.limit(0)).collect()
    assert (row.queries, row.behind, row.input_rate) == (0, None, 0.0)


def _source(**given):
    return SimpleNamespace(**{"latestOffset": None, "endOffset": None} | given)


@pytest.mark.parametrize(
    "sources,want",
    [
        ([], None),
        ([_source()], None),
        ([_source(latestOffset='{"t":{"0":90,"1":7}}', endOffset='{"t":{"0":80,"1":7}}')], 10),
        ([_source(latestOffset='{"t":{"0":9,"1":7}}', endOffset='{"t":{"0":9}}')], 0),
        ([_source(latestOffset="12", endOffset="5"), _source(), _source(latestOffset="9", endOffset="6")], 10),
        ([_source(latestOffset="no json", endOffset="{")], None),
    ],
)
def test_behind(sources, want):
    assert progress.behind(sources) == want


def test_rows_that_could_not_be_written_are_kept(spark, tmp_path):
    listener = progress.ProgressTable(spark, str(tmp_path / "file" / "table"))
    (tmp_path / "file").write_text("in the way")
    listener.held = [("q", "r", 1, "2025-01-01T00:00:00.000Z", 5, 1.0, 2.0, 30, None, 0, 0, 0)]
    listener._try_flush()
    assert len(listener.held) == 1
    listener.path = str(tmp_path / "table")
    listener.flush()
    assert listener.held == [] and progress.read(spark, listener.path).first().input_rows == 5
