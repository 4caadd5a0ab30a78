"""Fact tables: whole versions only, few files opened, old files collected."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickbars.operators import facts
from tickbars.plans import marts
from tickbars.sinks import versioned

T0 = 1_735_822_800_000
LOAD = dt.datetime(2025, 1, 3)
DAY = 86_400_000


@pytest.fixture
def fact_of(bars_of):
    return lambda rows: facts.fact_1s(bars_of(rows), LOAD)


def _read(spark, path, like, **given):
    rows = versioned.read(spark, path, facts.with_trade_hour(like).schema, **given)
    return sorted((r.symbol, r.start_ts.isoformat(), float(r.close)) for r in rows.collect())


def _rows(frame):
    return sorted((r.symbol, r.start_ts.isoformat(), float(r.close)) for r in frame.collect())


def test_upsert(spark, fact_of, tmp_path):
    path = str(tmp_path / "fact")
    first = fact_of([("A", T0, 1, 1), ("A", T0 + DAY, 2, 1), ("B", T0, 3, 1)])
    assert versioned.upsert(spark, first, path, batch=0) == 1
    second = fact_of([("A", T0, 9, 1), ("C", T0 + 2 * DAY, 4, 1)])
    assert [versioned.upsert(spark, second, path, batch=1) for _ in range(2)] == [2, 2]
    want = _rows(fact_of([("A", T0, 9, 1), ("A", T0 + DAY, 2, 1), ("B", T0, 3, 1), ("C", T0 + 2 * DAY, 4, 1)]))
    assert _read(spark, path, first) == want
    assert _read(spark, path, first, version=1) == _rows(first)
    assert versioned.upsert(spark, first.limit(0), path, batch=2) == 2
    kept = [r.file for r in versioned.manifest(spark, path).collect() if r.file.startswith("version=1/")]
    assert len(kept) == 1  # the hour of the next day went over as it was


def test_missing_version(spark, fact_of, tmp_path):
    path = str(tmp_path / "fact")
    assert _read(spark, path, fact_of([("A", T0, 1, 1)])) == []
    with pytest.raises(ValueError):
        versioned.manifest(spark, path, 7)


def test_readers_see_old_or_new_at_every_moment(spark, fact_of, tmp_path, monkeypatch):
    """A read between any two steps of an upsert, and one after each file it writes or deletes was put in or taken out."""
    path = str(tmp_path / "fact")
    old = fact_of([("A", T0 + k * 3_600_000, 1 + k, 1) for k in range(4)])
    versioned.upsert(spark, old, path, batch=0)
    new = fact_of([("A", T0 + k * 3_600_000, 50 + k, 1) for k in range(4)])
    seen = []

    def look(step):
        seen.append((step, _read(spark, path, old)))

    publish = versioned.publish

    def watched_publish(*args):
        look("data written")
        manifests = tmp_path / "fact" / "_versions"
        publish(*args)
        newest = max(p for p in manifests.iterdir() if p.is_dir())
        # Take the manifest's files out and put them back one by one, the mark of completeness last, as the job does.
        files = {p.name: p.read_bytes() for p in newest.iterdir()}
        for p in newest.iterdir():
            p.unlink()
        for name in sorted(files, key=lambda n: n == "_SUCCESS"):
            look(f"before {name}")
            (newest / name).write_bytes(files[name])
        look("published")

    monkeypatch.setattr(versioned, "publish", watched_publish)
    versioned.upsert(spark, new, path, batch=1)
    versioned.collect(spark, path, 1)
    look("collected")
    before, after = _rows(old), _rows(new)
    assert len(seen) >= 5 and seen[0][1] == before and seen[-1][1] == after
    assert all(rows in (before, after) for _, rows in seen), [s for s, rows in seen if rows not in (before, after)]


def test_a_failed_try_is_written_over(spark, fact_of, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    old = fact_of([("A", T0, 1, 1), ("A", T0 + 1000, 2, 1)])
    versioned.upsert(spark, old, path, batch=0)
    publish = versioned.publish

    def dies(*args):
        raise OSError("lost")

    monkeypatch.setattr(versioned, "publish", dies)
    with pytest.raises(OSError):
        versioned.upsert(spark, fact_of([("B", T0, 7, 1)]), path, batch=1)
    assert _read(spark, path, old) == _rows(old)
    monkeypatch.setattr(versioned, "publish", publish)
    versioned.upsert(spark, fact_of([("A", T0, 9, 1)]), path, batch=1)
    assert _read(spark, path, old) == _rows(fact_of([("A", T0, 9, 1), ("A", T0 + 1000, 2, 1)]))


def test_pinned_reader_and_collection(spark, fact_of, tmp_path):
    path = str(tmp_path / "fact")
    like = fact_of([("A", T0, 0, 1)])
    versioned.upsert(spark, like, path, batch=0)
    pinned = versioned.read(spark, path, facts.with_trade_hour(like).schema)
    for batch in range(1, 9):
        versioned.upsert(spark, fact_of([("A", T0, batch, 1), ("B", T0 + batch * DAY, batch, 1)]), path, batch=batch)
        if batch == 2:
            assert [float(r.close) for r in pinned.collect()] == [0.0]
    assert [v for v, _ in versioned.versions(spark, path)] == [7, 8, 9]
    on_disk = {str(p.relative_to(tmp_path / "fact" / "data")) for p in (tmp_path / "fact" / "data").rglob("*.parquet")}
    live = set()
    for version, _ in versioned.versions(spark, path):
        live |= {r.file for r in versioned.manifest(spark, path, version).collect()}
    assert on_disk == live


def test_movers_open_only_files_of_the_last_hour(spark, tmp_path):
    """Ninety stored days of five-minute bars, one every eight hours."""
    path = str(tmp_path / "fact")
    start = dt.datetime(2025, 1, 1)
    rows = spark.range(90 * 3).selectExpr(
        "concat('A-', id) AS bar_id", "'A' AS symbol", f"timestamp'{start}' + make_interval(0, 0, 0, 0, int(8 * id + 7), 50, 0) AS start_ts",
        f"timestamp'{start}' + make_interval(0, 0, 0, 0, int(8 * id + 7), 55, 0) AS end_ts", "CAST(10 AS DECIMAL(18,6)) AS open",
        "CAST(10 + id AS DECIMAL(18,6)) AS close", "CAST(1 AS DECIMAL(18,6)) AS volume",
    )
    versioned.upsert(spark, rows, path, batch=0)
    as_of = start + dt.timedelta(days=90)
    got = marts.stored_top_movers(spark, path, facts.with_trade_hour(rows).schema, as_of)
    assert len(got.inputFiles()) == 1 and versioned.manifest(spark, path).count() == 90 * 3
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in marts.top_movers(rows, as_of).collect()]


def test_hours_of_touched_rows_only(spark, fact_of, tmp_path):
    path = str(tmp_path / "fact")
    frame = fact_of([("A", T0 + k * 3_600_000, k, 1) for k in range(6)])
    versioned.upsert(spark, frame, path, batch=0)
    got = versioned.in_hours(spark, path, facts.with_trade_hour(frame).schema, frame.where(F.col("close") == 3))
    assert [float(r.close) for r in got.collect()] == [3.0] and len(got.inputFiles()) == 1
