from __future__ import annotations

import random
import re

from tickbars.operators import lateness, ordering


def _lateness(rows):
    """Brute force: lateness per row in arrival order."""
    newest, out = {}, []
    for i, (symbol, time, *_rest) in enumerate(rows):
        seen = newest.get(symbol, 0)
        out.append((i, max(seen - time, 0)))
        newest[symbol] = max(seen, time)
    return out


def _run(frame, **kwargs):
    got = lateness.with_lateness(frame, "arrival_seq", "event_ts_ms", **kwargs)
    return sorted((r.arrival_seq, r.lateness_ms) for r in got.select("arrival_seq", "lateness_ms").collect())


def test_bound_is_inclusive(ticks_of):
    rows = [("A", 10_000, 1, 1), ("A", 9_501, 1, 1), ("A", 9_500, 1, 1), ("A", 9_499, 1, 1)]
    got = lateness.with_lateness(ticks_of(rows), "arrival_seq", "event_ts_ms")
    assert [r.lateness_ms for r in lateness.accepted(got).orderBy("arrival_seq").collect()] == [0, 499, 500]
    letters = lateness.late_tick_letters(got).collect()
    assert [(r.reason, r.lateness_ms, r.tick.arrival_seq) for r in letters] == [("late_tick", 501, 3)]


def test_watermark_is_per_symbol(ticks_of):
    rows = [("A", 1_000, 1, 1), ("B", 3_601_000, 1, 1), ("A", 1_010, 1, 1), ("B", 3_601_010, 1, 1)]
    assert [late for _, late in _run(ticks_of(rows))] == [0, 0, 0, 0]


def test_chunks_agree_with_brute_force_on_a_hot_symbol(spark, ticks_of):
    rng = random.Random(7)
    rows, now = [], 100_000
    for _ in range(600):
        now += rng.randint(0, 40)
        rows.append((rng.choice(["HOT", "HOT", "HOT", "A", "B"]), now - rng.choice([0, 0, 0, 300, 900]), 1, 1))
    frame = ticks_of(rows)
    assert _run(frame, rows_per_chunk=50) == _lateness(rows)
    sizes = _sizes(frame, 50)
    assert len(sizes) >= 10 and max(sizes) <= 100


def test_chunks_hold_when_all_rows_share_one_time(spark, ticks_of):
    rows = [("HOT", 5_000, 1, 1)] * 300
    frame = ticks_of(rows)
    assert max(_sizes(frame, 30)) <= 60
    assert _run(frame, rows_per_chunk=30) == [(i, 0) for i in range(300)]


def test_one_plan_at_every_size(spark, ticks_of):
    """Few and many chunks run the same operators, and nothing runs while the plan is built."""

    def operators(frame, rows_per_chunk):
        judged = lateness.with_lateness(frame, "arrival_seq", "event_ts_ms", rows_per_chunk=rows_per_chunk)
        plan = judged._jdf.queryExecution().optimizedPlan().toString()
        return re.findall(r"^[ :+-]*([A-Z][A-Za-z]+)", plan, re.MULTILINE)

    frame = ticks_of([("A", i, 1, 1) for i in range(50)])
    assert operators(frame, 10) == operators(frame, 1_000_000)
    assert "Window" in operators(frame, 10)
    assert _sizes(frame, 1_000_000) == [50] and _sizes(frame.limit(0), 10) == []


def _sizes(frame, rows_per_chunk):
    chunked = ordering.with_even_chunk(frame, "arrival_seq", rows_per_chunk, "chunk")
    return [r["count"] for r in chunked.groupBy("chunk").count().collect()]


def test_counts(ticks_of):
    rows = [("A", 10_000, 1, 1), ("A", 9_000, 1, 1), ("A", 8_000, 1, 1), ("B", 10_000, 1, 1)]
    got = lateness.with_lateness(ticks_of(rows), "arrival_seq", "event_ts_ms")
    counted = lateness.late_counts(lateness.late_tick_letters(got)).collect()
    assert [tuple(r) for r in counted] == [("A", "late_tick", 2, 2000)]
