"""The pipeline against its stages in plain Python."""

from __future__ import annotations

import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontam, test_linechunks, test_neardup, test_packing, test_rules


def expected(rows, bench):
    """The (id, text) rows that reach packing."""
    rows = [(i, t) for i, t in rows if test_rules.verdict(t)]
    cut = test_linechunks.plain(rows)
    rows = [(i, cut[i]) for i, t in rows if cut[i] or not t]
    rows = [(i, t) for i, t in rows if next(r for r in test_neardup.plain(rows) if r[0] == i)[3]]
    return [(i, t) for i, t in rows if not test_decontam.plain(t, bench)[3]]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_run(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = dict(expected(rows, bench))
    assert 50 < len(left) < len(rows)
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    bins = test_packing.checked(packed, left, library)
    assert bins <= -(-sum(r.length for r in packed) // 4096) + 1


def staged(spark, frame, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir)
        yield frame


def test_stages_keep_columns_and_survive_odd_rows(spark, sf_dir, docs_of):
    rng = random.Random(1)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    whole = "\n".join(line() for _ in range(8))
    near = whole.replace("w1", "v1", 1)
    rows = [(1, whole), (1, whole), (2, whole), (3, near + "\n" + line()), (None, line()), (5, None), (6, ""), (7, "x " * 50_000), (8, line() + " one")]
    frame = docs_of(rows).selectExpr("*", "1 AS n_words", "'k' AS node", "2 AS hash", "3 AS `a.b`", "4 AS places")
    for out in staged(spark, frame, sf_dir):
        assert out.columns == frame.columns
        last = sorted(((r.doc_id, len(r.text), r.n_chars) for r in out.collect()), key=str)
    ids = [i for i, _, _ in last]
    assert ids.count(1) == 1 and 2 not in ids and None in ids and 8 in ids and not {5, 6, 7} & set(ids)
    assert all(n == chars for _, n, chars in last)


def test_empty_table(spark, sf_dir, docs_of):
    frame = docs_of([(1, "a b")]).limit(0)
    for out in staged(spark, frame, sf_dir):
        assert out.count() == 0
    assert corpus_pipeline.pack(spark, frame, sf_dir).count() == 0


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]
