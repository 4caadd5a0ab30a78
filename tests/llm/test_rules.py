"""Quality rules against a plain version."""

from __future__ import annotations

import random
import re

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from tickbars.llm import queries_rules, rules, spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for v in grams.values() if len(v) > 1 for i in v for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeated), failed


def verdict(text):
    raw, given_ = (text or "").encode(), rules.Rules()
    bands = given_.bands

    def judge(part):
        low, high = [(a, b) for n, a, b in zip(bands.lengths, bands.low, bands.high) if n <= len(part)][-1]
        ratio = len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))
        return (ratio > high) - (ratio < low)

    parts = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
    bad = any(sum(len(p) for p in parts if judge(p) == side) * 2 > len(raw) for side in (1, -1))
    return not (plain(text)[-1] or judge(raw) or bad) if raw else False


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries_rules.op10_quality_rules(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        r = got[row.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(row.text)
        assert r.kept == verdict(row.text)


def test_labelled_good_texts_stay(spark, sf_dir):
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    got = queries_rules.op10_quality_rules(spark, sf_dir).join(good, "doc_id").where("NOT kept AND NOT base_failed")
    assert got.count() == 0


def test_edge_rows(spark, docs_of):
    noise = random.Random(1)
    texts = [None, "", "\n\n", "one two", " ".join(f"w{i}é" for i in range(40)), " ".join("%030x" % noise.getrandbits(120) for _ in range(90)), "ab cd " * 400, "x" * 300_000]
    frame = docs_of(texts).selectExpr("*", "1 AS kept", "2 AS n_words")
    got = {r.doc_id: r for r in rules.judge_quality(frame).collect()}
    for i, text in enumerate(texts):
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words, got[i].base_failed) == plain(text)
        assert got[i].kept == verdict(text)
    assert got[4].kept and got[5].reason is None
    many = docs_of([(1, "a b"), (1, "a b"), (None, "a b")])
    assert sorted((r.doc_id or 0, r.kept) for r in rules.judge_quality(many).collect()) == [(0, False), (1, False), (1, False)]
    assert rules.judge_quality(many.limit(0)).count() == 0


def test_repetitive_and_incompressible():
    noise = random.Random(2)
    raw = bytes(noise.getrandbits(8) % 95 + 32 for _ in range(3000))
    bands = rules.Bands()
    pack = zstandard.ZstdCompressor(level=3).compress
    assert bands.judge(len(raw), len(pack(raw))) == -1
    same = b"many words in a row, and again. " * 90
    assert bands.judge(len(same), len(pack(same))) == 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab \n\té", max_size=40), min_size=1, max_size=6))
def test_words_of_blocks(texts):
    data, at = spans.buffers(pa.array(texts, pa.string()))
    words = spans.find_words(data, at)
    got = [bytes(data[a:b]).decode() for a, b in zip(words.start, words.end)]
    assert got == [w for t in texts for w in WORD.findall(t)]
    assert list(words.counts) == [len(WORD.findall(t)) for t in texts]
    hashes = spans.span_hashes(data, words.start, words.end)
    assert len(set(hashes.tolist())) == len(set(got))
    repeats = rules.repeat_words(hashes, words.first, 5)
    assert repeats.tolist() == [plain(t)[4] for t in texts]
    assert repeats.dtype == np.int64
