"""Line dedup against a plain version that walks lines one at a time."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickbars.llm import linechunks, queries_linechunks
from tickbars.llm.spans import STEP, U64, buffers, mix, seeded, span_hashes

CUTTING = linechunks.Cutting()
BLANK = " \t\r\x0b\x0c"


def value(line):
    raw = np.frombuffer(line.encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def kept_lines(text):
    """(start, end) of the lines that aren't blank."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        if line.strip(BLANK):
            out.append((at, at + len(line)))
        at += len(line) + 1
    return out


def chunks(text):
    """(first line, last line) of every chunk, rule by rule."""
    spans = kept_lines(text)
    values = [value(text[a:b]) for a, b in spans]
    found = set()
    with np.errstate(over="ignore"):
        rolling = [mix(np.array([x * STEP + y], U64)) for x, y in zip(values, values[1:])]
    for opening, closing in zip(seeded(CUTTING.rules, 21), seeded(CUTTING.rules, 22)):
        for i, r in enumerate(rolling):
            if int(mix(r ^ opening)[0]) % CUTTING.opens:
                continue
            for j in range(i, len(rolling)):
                if int(mix(rolling[j] ^ closing)[0]) % CUTTING.passes:
                    found.add((i, j + 1))
                    break
    return sorted(found)


def plain(rows):
    """(id, text) to id -> text for rows with ids of their own."""
    texts = dict(rows)
    spans = {i: kept_lines(t) for i, t in rows}
    places = {}
    for i in sorted(texts):
        for a, b in chunks(texts[i]):
            own = spans[i]
            places.setdefault(texts[i][own[a][0] : own[b][1]], []).append((i, a, b))
    firsts, hits = {}, {}
    for found in places.values():
        if len(found) < 2:
            continue
        i0, a0, b0 = found[0]
        firsts.setdefault(i0, set()).update(range(a0, b0 + 1))
        for i, a, b in found[1:]:
            t, s, t0, s0 = texts[i], spans[i], texts[i0], spans[i0]
            up = down = 0
            while up < linechunks.REACH and min(a, a0) > up and t[s[a - up - 1][0] : s[a - up][0]] == t0[s0[a0 - up - 1][0] : s0[a0 - up][0]]:
                up += 1
            while down < linechunks.REACH and b + down + 1 < len(s) and b0 + down + 1 < len(s0) and t[s[b + down][1] : s[b + down + 1][1]] == t0[s0[b0 + down][1] : s0[b0 + down + 1][1]]:
                down += 1
            hits.setdefault(i, {}).setdefault((i0, a - a0), set()).update((x, x + 1) for x in range(a - up, b + down))
    out = {}
    for i, text in rows:
        gone = set()
        runs = []
        for key, steps in hits.get(i, {}).items():
            ends = sorted(steps)
            start = ends[0][0]
            for k, (x, y) in enumerate(ends):
                if k + 1 == len(ends) or ends[k + 1][0] > y:
                    runs.append((start, y))
                    start = ends[k + 1][0] if k + 1 < len(ends) else None
        for a, b in sorted(runs, key=lambda r: (r[0] - r[1], r[0])):
            part = []
            for x in [*range(a, b + 1), None]:
                if x is not None and x not in gone and x not in firsts.get(i, ()):
                    part.append(x)
                else:
                    gone |= set(part) if len(part) > 1 else set()
                    part = []
        if not gone:
            out[i] = text
            continue
        keep = []
        at = 0
        for x in sorted(gone):
            if x - 1 not in gone:
                keep.append(text[at : spans[i][x][0]])
            at = spans[i][x][1] + 1
        left = "".join([*keep, text[at:]])
        out[i] = left if left.strip(BLANK + "\n") else ""
    return out


def run(docs, **given):
    return {r.doc_id: r for r in linechunks.drop_repeated_chunks(docs, **given).collect()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab \n", max_size=30), min_size=1, max_size=5))
def test_cutting(texts):
    data, at = buffers(pa.array(texts, pa.string()))
    found = linechunks.find_lines(data, at)
    made = linechunks.cut(data, found, CUTTING)
    for i, text in enumerate(texts):
        own = found.text == i
        assert [(a - at[i], b - at[i]) for a, b in zip(found.start[own], found.end[own])] == kept_lines(text)
        mine = found.text[made.line] == i if len(made.line) else []
        first = found.first[i]
        assert [(a - first, a - first + n - 1) for a, n in zip(made.line[mine], made.lines[mine])] == chunks(text)


def test_borders_depend_on_own_lines_only():
    rng = random.Random(1)
    passage = [f"line {rng.random()}" for _ in range(40)]
    whole = {tuple(passage[a : b + 1]) for a, b in chunks("\n".join(passage))}
    text = [f"new {rng.random()}" for _ in range(7)] + passage + [f"end {rng.random()}"]
    assert whole <= {tuple(text[a : b + 1]) for a, b in chunks("\n".join(text))}


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.text for r in queries_linechunks.op8_line_dedup(spark, sf_dir).collect()}
    expected = plain(rows)
    assert got == expected and any(got[i] != t for i, t in rows)


def line_of(rng, words=8):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))


@pytest.mark.parametrize("gap", ["\n", "\n\n"])
def test_recall_of_planted_passages(docs_of, gap):
    """Passages of 2 to 6 lines inside different documents: own lines stay, and nearly every copy goes whole."""
    rng = random.Random(5)
    rows, planted, heads = [], {}, {}
    for n in range(2, 7):
        for _ in range(40):
            passage = [line_of(rng) for _ in range(n)]
            for copy in range(3):
                head, tail = ([line_of(rng) for _ in range(rng.randrange(1, 5))] for _ in range(2))
                i = len(rows)
                rows.append((i, gap.join(head + passage + tail)))
                heads[i] = head + passage if copy == 0 else head, tail
                planted[i] = n if copy else 0
    got = run(docs_of(rows))
    assert {i: r.text for i, r in got.items()} == plain(rows)
    whole = {}
    for i, n in planted.items():
        left = [x for x in got[i].text.split("\n") if x]
        assert left[: len(heads[i][0])] == heads[i][0] and left[-len(heads[i][1]) :] == heads[i][1]
        if n:
            whole.setdefault(n, []).append(left == heads[i][0] + heads[i][1])
    assert all(np.mean(whole[n]) >= (0.88 if n == 2 else 0.97) for n in whole), {n: np.mean(x) for n, x in whole.items()}


def test_single_repeated_lines_beside_blank_ones_stay(docs_of):
    rows = [(1, "own1\nYes.\n\nmore1"), (2, "own2\nYes.\n\nmore2"), (3, "own3\nThe end.\n"), (4, "own4\nThe end.\n"), (5, "\n\n\n"), (6, "\n\n\n")]
    assert {i: r.text for i, r in run(docs_of(rows)).items()} == dict(rows)


def test_stitched_passages_stay(docs_of):
    """``p q`` and ``q r`` stand elsewhere, ``p q r`` doesn't: at most one of the two goes."""
    for seed in range(8):
        rng = random.Random(seed)
        p, q, r = (line_of(rng) for _ in range(3))
        rows = [(1, f"{p}\n{q}\nz1"), (2, f"z2\n{q}\n{r}"), (3, f"k\n{p}\n{q}\n{r}\nl")]
        got = run(docs_of(rows))
        assert {i: x.text for i, x in got.items()} == plain(rows)
        assert p in got[3].text or r in got[3].text


def test_edge_rows(docs_of):
    rng = random.Random(3)
    part = "\n".join(line_of(rng) for _ in range(12))
    rows = [(0, None), (1, ""), (2, "\n\n\n\n"), (3, "\n\n\n\n"), (4, part), (5, part + "\n"), (6, "own start\n" + part + "\nown end"), (7, part + "\n" + part), (8, "one line"), (9, "one line"), (10, "a\n" * 50), (11, "b\n \nc\n\n"), (12, "b\n \nc\n\n")]
    frame = docs_of(rows).selectExpr("*", "1 AS n_lines", "2 AS hash", "3 AS number", "4 AS marks", "5 AS source", "6 AS `a.b`")
    got = run(frame, prefix="x_", keep=("doc_id", "text", "n_lines", "marks", "a.b"))
    assert {i: r.text for i, r in got.items()} == plain(rows)
    assert got[5].text == "" and got[5].x_n_removed_lines == got[5].x_n_lines == 13
    assert got[4].text == part and got[3].text == "\n\n\n\n" and got[0].text is None and got[0].x_n_lines == 0
    assert got[6].text == "own start\nown end" and got[6].x_n_removed_lines == 12 and got[7].text == ""
    assert got[11].marks == 4 and got[11]["a.b"] == 6 and len(got[10].text) < 100
    assert linechunks.drop_repeated_chunks(frame.limit(0), prefix="x_").count() == 0
    with pytest.raises(ValueError):
        linechunks.drop_repeated_chunks(frame, keep=("doc_id", "n_lines"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_few_different_lines(docs_of, seed):
    """Ties everywhere: lines repeat within texts and between them, with blank lines in between."""
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["alpha", "beta", "gamma", "", "delta "]) for _ in range(rng.randrange(14)))) for i in range(40)]
    assert {i: r.text for i, r in run(docs_of(rows)).items()} == plain(rows)


def test_long_text(docs_of):
    rng = random.Random(8)
    lines = [line_of(rng, 12) for _ in range(30_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["start", *lines[9_000:21_000], "end"]))]
    got = run(docs_of(rows))
    assert got[1].text == rows[0][1] and got[2].text == "start\nend" and got[2].n_removed_lines == 12_000


def test_repeated_rows_and_null_ids(docs_of):
    rng = random.Random(4)
    part = "\n".join(line_of(rng) for _ in range(6))
    got = sorted(map(tuple, linechunks.drop_repeated_chunks(docs_of([(3, part), (3, part), (4, part)])).select("doc_id", "text").collect()))
    assert got == [(3, part), (3, part), (4, "")]
    assert {i: r.text for i, r in run(docs_of([(None, part), (4, part)])).items()} == {None: part, 4: ""}


def test_copies_of_one_chunk_in_bulk(docs_of):
    rng = random.Random(4)
    part = "\n".join(line_of(rng) for _ in range(6))
    got = linechunks.drop_repeated_chunks(docs_of([(i, part) for i in range(400)])).where("text <> ''").collect()
    assert [r.doc_id for r in got] == [0]


def test_rows_that_share_an_id_only(docs_of):
    """A passage at the start of many texts with one id, null or not, is repeated in all but one."""
    rng = random.Random(6)
    part = "\n".join(line_of(rng) for _ in range(6))
    for i in (None, 7):
        rows = [(i, f"{part}\nown {k}\nend {k}") for k in range(20)]
        got = [r.text for r in linechunks.drop_repeated_chunks(docs_of(rows)).collect()]
        assert sorted(len(t.split("\n")) for t in got) == [2] * 19 + [8]
        assert {t[-len(f"own {k}\nend {k}") :] for k, t in enumerate(sorted(got, key=lambda t: int(t.split()[-1])))} == {f"own {k}\nend {k}" for k in range(20)}
