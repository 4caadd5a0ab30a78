"""Decontamination against a plain search."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tickbars.llm import decontam, queries_decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, bench):
    own = words(text)
    hit, items = set(), set()
    for item, passage in bench:
        w = words(passage)
        size = min(13, len(w))
        strings = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
        for k in range(len(own) - size + 1):
            if tuple(own[k : k + size]) in strings:
                hit |= set(range(k, k + size))
                items.add(str(item))
    return len(own), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(own)


LETTERS = st.lists(st.sampled_from(["a", "b", "B", "c!", "é"]), max_size=40).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(LETTERS, st.lists(LETTERS, max_size=4))
def test_search(text, passages):
    bench = list(enumerate(passages))
    own = decontam.words_of(text.encode())
    spans, items = decontam.find(decontam.build([(str(i), t) for i, t in bench], 13), own)
    n, hit, expected, _ = plain(text, bench)
    assert (len(own), sum(b - a for a, b in spans), sorted(items)) == (n, hit, expected)


def test_words():
    for c in range(0x250):
        text = f"a{chr(c)}B"
        assert [w.decode() for w in decontam.words_of(text.encode())] == words(text)


BENCH = [(1, "the quick brown fox jumps over the lazy dog and runs away from it all now"), (2, "Short item"), (3, None), (4, ""), (2, "short, ITEM"), (10, "the quick brown fox jumps over the lazy dog and runs away from nobody")]


def test_edge_rows_and_blocks(spark, docs_of):
    texts = [None, "", BENCH[0][1].upper(), "x " * 300 + BENCH[0][1], "short\nitem", "Short items", "y " * 5000 + "short item", "a b c"]
    bench = spark.createDataFrame(BENCH, "item_id BIGINT, text STRING")
    frame = docs_of(texts).selectExpr("*", "1 AS n_words", "2 AS spans")
    for limit in (1, 10**6):
        got = {r.doc_id: r for r in decontam.find_contamination(frame, bench, table_bytes=limit).collect()}
        for i, text in enumerate(texts):
            assert (got[i].n_words, got[i].n_hit, got[i]["items"], got[i].contaminated) == plain(text, BENCH)
    assert decontam.find_contamination(frame, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.find_contamination(frame.limit(0), bench).count() == 0
    twice = docs_of([(1, "short item"), (1, "short item"), (None, "short item")])
    assert [r.n_hit for r in decontam.find_contamination(twice, bench).collect()] == [2, 2, 2]


def test_null_item_id(spark, docs_of):
    bench = spark.createDataFrame([(None, "two words")], "item_id BIGINT, text STRING")
    row = decontam.find_contamination(docs_of(["two words"]), bench).first()
    assert (row.n_hit, row["items"], row.contaminated) == (2, [], True)


def test_query(spark, sf_dir):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in queries_decontam.op6_decontaminate(spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n, hit, items, bad = plain(row.text, bench)
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        r = got[row.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(items), digest, bad)
