"""Quality network: layers against plain loops, gradients against differences, held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tickbars.llm import byte_cnn, queries_quality
from tickbars.llm.spans import buffers

SMALL = byte_cnn.Training(filters=3, embedding=2, epochs=2, batch=4)
TEXTS = [b"", b"a", b"hello world", b"abcab" * 200, bytes(range(256)) * 5, "é".encode() * 128, b"x" * 256, b"y" * 257]


def plain_features(text, model):
    """By walking every chunk and byte."""
    raw = (text or b"\0") + b"\0" * (byte_cnn.WIDTH - 1)
    n = max(len(text), 1)
    halves = []
    for at in range(0, n, byte_cnn.HALF):
        stop = min(at + byte_cnn.HALF, n)
        answers = [sum(model.embed[raw[t + k]] @ model.filters[k] for k in range(byte_cnn.WIDTH)) for t in range(at, stop)]
        part = raw[at:stop]
        agree = max(sum(part[i] == part[i - s] for i in range(s, len(part))) for s in byte_cnn.SHIFTS) / max(len(part), 64)
        halves.append(np.append(np.maximum(np.max(answers, axis=0) + model.bias, 0), agree))
    parts = [np.maximum(a, b) for a, b in zip(halves, halves[1:])] or halves
    return np.concatenate([np.max(parts, axis=0), np.mean(parts, axis=0)])


def features(texts, model):
    layout = byte_cnn.lay_out(*buffers(pa.array(texts, pa.binary())))
    return byte_cnn.pooled(byte_cnn.half_maxima(layout, model), byte_cnn.agreement(layout), layout.first, model)


def test_features_of_a_block():
    model = byte_cnn.new_model(SMALL)
    got = features(TEXTS, model)
    for text, row in zip(TEXTS, got, strict=True):
        np.testing.assert_allclose(row, plain_features(text, model), rtol=1e-4, atol=1e-5)
    np.testing.assert_allclose(features(TEXTS[3:4], model)[0], got[3], rtol=1e-5)


def test_gradients():
    model = byte_cnn.new_model(SMALL)
    model.bias += 0.05
    layout = byte_cnn.lay_out(*buffers(pa.array(TEXTS, pa.binary())))
    agree = byte_cnn.agreement(layout)
    labels = np.array([0, 1, 1, 0, 1, 0, 1, 0], np.float32)

    def loss():
        z = byte_cnn.pooled(byte_cnn.half_maxima(layout, model), agree, layout.first, model).astype(float) @ model.out + model.level[0]
        return float(np.mean(np.logaddexp(0, z) - labels * z))

    grads = byte_cnn._gradients(layout, agree, labels, model)
    rng = np.random.default_rng(1)
    for part, grad in zip(model.parts, grads, strict=True):
        for _ in range(6):
            k = tuple(int(rng.integers(0, n)) for n in part.shape)
            if part is model.embed:
                k = (int(rng.choice([97, 98, 120, 121])), k[1])
            old = part[k]
            part[k] = old + 1e-2
            up = loss()
            part[k] = old - 1e-2
            down = loss()
            part[k] = old
            assert abs((up - down) / 2e-2 - grad[k]) < 2e-3 + 0.1 * abs(grad[k])


@pytest.fixture(scope="module")
def scored(spark):
    sf_dir = "/root/testdata/sf0.01"
    return sf_dir, queries_quality.op7_quality_classifier(spark, sf_dir).collect()


def test_held_out_accuracy(spark, scored):
    sf_dir, rows = scored
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    assert len(good) > 30 and len(bad) > 3
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([p == y for _, p, y in held]) > 0.92


def test_rows(spark, scored):
    sf_dir, rows = scored
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len(rows) == docs and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_edge_rows(spark, docs_of):
    model = byte_cnn.new_model(SMALL)
    frame = docs_of([(1, None), (1, ""), (None, "a b"), (2, "z" * 100_000)]).selectExpr("*", "9 AS score")
    got = byte_cnn.score_texts(frame.drop("score"), model, keep=("doc_id", "text")).collect()
    by = {r.text and r.text[:1]: r.score for r in got}
    assert len(got) == 4 and by[None] == by[""]
    assert byte_cnn.score_texts(frame.limit(0), model).count() == 0


def test_labels_of_one_class_or_none(spark, docs_of):
    docs = docs_of(["a b", "c d", None])
    kind = "doc_id BIGINT, quality INT"
    for rows, expected in (([], 0.5), ([(0, 1), (1, 1)], 1.0), ([(0, 0), (None, 1), (2, None)], 0.0)):
        model = byte_cnn.train_classifier(docs, spark.createDataFrame(rows, kind), "quality", training=SMALL)
        got = byte_cnn.score_texts(docs, model).collect()
        assert all(abs(r.score - expected) < 1e-6 for r in got)


def test_same_input_same_network():
    labels = np.array([0, 1] * 4, np.float32)
    a, b = (byte_cnn.fit(TEXTS, labels, SMALL) for _ in range(2))
    assert all((x == y).all() for x, y in zip(a.parts, b.parts))
