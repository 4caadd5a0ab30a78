"""Repeated byte strings against brute force, and the suffix sort against Python's."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickbars.llm import exactdedup, queries_exactdedup, suffixes
from tickbars.llm.spans import buffers


def plain(texts, length):
    """Per text (bytes, removed spans, rest)."""
    raws = [(t or "").encode() for t in texts]
    counts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        spans, at = [], None
        for i, g in enumerate(gone.tolist()):
            if g and at is None:
                at = i
            if not g and at is not None:
                spans.append((at, i))
                at = None
        out.append((len(raw), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 4), st.sampled_from([0, 8, 16, 32]))
def test_suffix_sort(seed, limit, letters, shallow):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, letters, int(rng.integers(limit + 1, 300 + limit))).astype(np.uint8) * 63
    start = rng.permutation(len(text) - limit + 1)
    bucket = rng.integers(0, 3, len(start))
    order, same = suffixes.sort_suffixes(text, start, bucket, limit, shallow)
    found = [(int(bucket[i]), bytes(text[start[i] : start[i] + limit])) for i in order]
    assert found == sorted(found) and sorted(order.tolist()) == list(range(len(start)))
    assert same.tolist() == [i > 0 and found[i] == found[i - 1] for i in range(len(found))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abé", max_size=60), min_size=1, max_size=4))
def test_equal_strings_have_equal_anchors(texts):
    plan = exactdedup.Repeats(length=12, gram=4)
    data, offsets = buffers(pa.array(texts, pa.string()))
    found = exactdedup.runs(data, offsets, plan)
    raw, seen, places = data.tobytes(), {}, set()
    for text, first, last, anchor, key in zip(*(found[k].tolist() for k in ("text", "first", "last", "anchor", "key"))):
        for p in range(first, last + 1):
            assert offsets[text] <= p and p + 12 <= offsets[text + 1] and p <= anchor <= p + 8
            assert seen.setdefault(raw[p : p + 12], (key, anchor - p)) == (key, anchor - p)
            places.add(p)
    assert len(places) == sum(max(int(n) - 11, 0) for n in np.diff(offsets))


def answer(frame, plan=None):
    cut = exactdedup.remove_repeats(frame, plan=plan) if plan else exactdedup.remove_repeats(frame)
    return {r.doc_id: (r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in cut.collect()}


def crowd(seed, n, length):
    """Texts that share passages just below and above the length, amid others of their own, and copies."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefgh é\n") for _ in range(k))
    shared = [word(length - 3), word(length + 5), word(2 * length), word(length // 2)]
    texts = []
    for _ in range(n):
        text = word(rng.randrange(2 * length))
        for _ in range(rng.randrange(4)):
            text += rng.choice(shared) + word(rng.randrange(length))
        texts.append(text)
    texts += texts[:4] + [t[: len(t) // 2] + "Z" + t[len(t) // 2 :] for t in texts[:20]] + ["ab" * length, "x" * 3 * length, None, "", shared[0]]
    return texts


@pytest.mark.parametrize(("limit", "parts"), [(512, 8), (3, 8), (2, 2)])
def test_crowded_anchors(spark, docs_of, limit, parts):
    """Every lane: whole repeats, sorted groups, and anchors split until one offset is left."""
    texts = crowd(limit, 60, 50)
    plan = exactdedup.Repeats(length=50, gram=8, crowd=limit, parts=parts, sorted_places=300)
    expected = plain(texts, 50)
    got = answer(docs_of(texts), plan)
    for i, e in enumerate(expected):
        assert got[i] == e, (i, texts[i])


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries_exactdedup.op9_suffix_dedup(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    removed = 0
    for row, (n, spans, rest) in zip(rows, plain([r.text for r in rows], 400), strict=True):
        r = got[row.doc_id]
        gone = sum(b - a for a, b in spans)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, len(spans), hashlib.sha256(rest).hexdigest())
        removed += gone
    assert removed


def test_edge_rows(spark, docs_of):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, long), (1, long), (2, None), (3, ""), (4, long[:399]), (5, "other " + long[100:600]), (6, "z" * 401), (7, "z" * 400), (8, "q" * 400)]
    frame = docs_of(rows).selectExpr("*", "1 AS removed", "2 AS key", "3 AS body")
    got = exactdedup.remove_repeats(frame).collect()
    assert sorted((r.doc_id, len(r.kept)) for r in got) == [(1, 0), (1, 0), (2, 0), (3, 0), (4, 399), (5, 6), (6, 0), (7, 0), (8, 400)]
    told_apart = [(1, long), (1, "y" + long[:1500][::-1]), (None, long), (None, "w" * 500)]
    got = exactdedup.remove_repeats(docs_of(told_apart)).collect()
    assert sorted(len(r.kept) for r in got) == [0, 0, 0, 1501]
    assert exactdedup.remove_repeats(frame.limit(0)).count() == 0


def test_very_long_text():
    """Pieces of one text beyond the range of places give the runs of the whole."""
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, (1 << 23) + 5000).astype(np.uint8)
    plan = exactdedup.Repeats()
    places = 0
    for _, start, end in exactdedup._pieces(data, np.array([0, len(data)]), plan.length):
        part = exactdedup.runs(data[start:end], np.array([0, end - start]), plan)
        places += int((part["last"] - part["first"] + 1).sum())
    assert places == len(data) - 399
