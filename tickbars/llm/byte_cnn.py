"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A text is cut into chunks of 512 bytes that overlap by half, the whole of it. Bytes are embedded, learned filters of five
bytes slide over every chunk, and each filter's strongest answer in the chunk is kept. Beside them stands one more
channel of the chunk, how well it agrees with itself some bytes on (repeated words), the strongest over the shifts. The
maximum and the mean over all chunks go into one probability.

The embedding and a filter's weights only ever meet as a table of 256 rows, so scoring adds up five table rows for each
byte and keeps maxima of half chunks; overlapping chunks are maxima of neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import blocks, mapped, named, texts_of
from tickbars.llm.spans import buffers

WIDTH, HALF = 5, 256
SHIFTS = range(2, 34)
BLOCK = 1_000_000


@dataclass(frozen=True)
class Training:
    """At most ``rows`` labelled texts of each class, of ``text_bytes`` at most, are gathered to fit the network."""

    rows: int = 1000
    text_bytes: int = 16_384
    filters: int = 16
    embedding: int = 8
    epochs: int = 8
    batch: int = 32
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    embed: np.ndarray  # 256 x embedding
    filters: np.ndarray  # width x embedding x filters
    bias: np.ndarray
    out: np.ndarray  # 2 * (filters + 1)
    level: np.ndarray  # one number

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.level]


def new_model(training: Training) -> Model:
    rng = np.random.default_rng(training.seed)
    e, f = training.embedding, training.filters
    return Model(
        rng.normal(0, 0.5, (256, e)).astype(np.float32),
        rng.normal(0, 1 / np.sqrt(WIDTH * e), (WIDTH, e, f)).astype(np.float32),
        np.zeros(f, np.float32),
        rng.normal(0, 0.1, 2 * (f + 1)).astype(np.float32),
        np.zeros(1, np.float32),
    )


@dataclass
class Layout:
    """Padded bytes of a block and its half chunks; an empty text is one zero byte."""

    data: np.ndarray
    start: np.ndarray  # of each half chunk
    size: np.ndarray
    first: np.ndarray  # first half chunk of each text, and the number of all


def lay_out(data: np.ndarray, offsets: np.ndarray) -> Layout:
    lens = np.diff(offsets)
    held = np.maximum(lens, 1)
    at = np.concatenate([[0], np.cumsum(held + WIDTH - 1)])
    padded = np.zeros(int(at[-1]), np.uint8)
    padded[np.arange(len(data)) + np.repeat(at[:-1] - offsets[:-1], lens)] = data
    halves = -(-held // HALF)
    first = np.concatenate([[0], np.cumsum(halves)])
    place = np.arange(int(first[-1])) - np.repeat(first[:-1], halves)
    start = np.repeat(at[:-1], halves) + place * HALF
    size = np.minimum(np.repeat(held, halves) - place * HALF, HALF)
    return Layout(padded, start, size, first)


def agreement(layout: Layout) -> np.ndarray:
    """For each half chunk the largest share of its bytes that equal the byte some shift further back in it."""
    best = np.zeros(len(layout.start), np.float32)
    bounds = np.stack([layout.start, layout.start + layout.size], 1).ravel()
    for shift in SHIFTS:
        equal = np.zeros(len(layout.data) + 1, np.uint8)
        equal[shift:-1] = layout.data[shift:] == layout.data[:-shift]
        inner = bounds.copy()
        inner[0::2] = np.minimum(inner[0::2] + shift, inner[1::2])
        sums = np.add.reduceat(equal, inner, dtype=np.int32)[0::2]
        sums[inner[0::2] == inner[1::2]] = 0
        np.maximum(best, sums / np.maximum(layout.size, 64), out=best, casting="unsafe")
    return best


def half_maxima(layout: Layout, model: Model) -> np.ndarray:
    """The strongest answer of every filter in every half chunk."""
    tables = model.embed @ model.filters  # width x 256 x filters
    out = np.empty((len(layout.start), len(model.bias)), np.float32)
    step = 4096  # positions at a time, so that sums stay in the cache
    ends = layout.start + layout.size
    done = 0
    while done < len(ends):
        stop = max(int(np.searchsorted(layout.start, layout.start[done] + step)), done + 1)
        low, high = int(layout.start[done]), int(ends[stop - 1])
        sums = tables[0].take(layout.data[low:high], axis=0)
        for k in range(1, WIDTH):
            sums += tables[k].take(layout.data[low + k : high + k], axis=0)
        marks = np.stack([layout.start[done:stop], ends[done:stop]], 1).ravel() - low
        out[done:stop] = np.maximum.reduceat(sums, marks[:-1], axis=0)[0::2]
        done = stop
    return out


def pooled(maxima: np.ndarray, agree: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Per text the maximum and mean over its chunks of every filter, and of the agreement."""
    values = np.concatenate([np.maximum(maxima + model.bias, 0), agree[:, None]], axis=1)
    chunk, chunk_first = chunks(first)
    both = np.maximum(values[chunk[:, 0]], values[chunk[:, 1]])
    heads = chunk_first[:-1]
    mean = np.add.reduceat(both, heads, axis=0) / np.diff(chunk_first)[:, None]
    return np.concatenate([np.maximum.reduceat(both, heads, axis=0), mean], axis=1)


def chunks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the two half chunks of each chunk, first chunk of each text); a short text's chunk is one half."""
    halves = np.diff(first)
    counts = np.maximum(halves - 1, 1)
    chunk_first = np.concatenate([[0], np.cumsum(counts)])
    left = np.arange(int(chunk_first[-1])) - np.repeat(chunk_first[:-1] - first[:-1], counts)
    return np.stack([left, left + np.repeat(halves > 1, counts)], 1), chunk_first


def scores(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    layout = lay_out(data, offsets)
    features = pooled(half_maxima(layout, model), agreement(layout), layout.first, model)
    return 1 / (1 + np.exp(-(features.astype(np.float64) @ model.out + model.level[0])))


def _gradients(layout: Layout, agree: np.ndarray, labels: np.ndarray, model: Model) -> list[np.ndarray]:
    """Gradients of the mean log loss; only the places of maxima take part."""
    halves, filters = len(layout.start), len(model.bias)
    place = layout.start[:, None] + np.arange(HALF + WIDTH - 1)
    held = layout.data[np.minimum(place, len(layout.data) - 1)]
    tables = model.embed @ model.filters
    answers = sum(tables[k][held[:, k : k + HALF]] for k in range(WIDTH))
    answers[np.arange(HALF) >= layout.size[:, None]] = -1e9
    where = answers.argmax(axis=1)
    maxima = np.take_along_axis(answers, where[:, None, :], 1)[:, 0]
    raised = maxima + model.bias
    values = np.concatenate([np.maximum(raised, 0), agree[:, None]], axis=1)
    chunk, chunk_first = chunks(layout.first)
    side = values[chunk[:, 1]] > values[chunk[:, 0]]
    both = np.where(side, values[chunk[:, 1]], values[chunk[:, 0]])
    features = pooled(maxima, agree, layout.first, model)
    error = 1 / (1 + np.exp(-(features @ model.out + model.level[0]))) - labels
    error /= len(labels)
    width = filters + 1
    to_chunk = np.empty_like(both)
    for i, e in enumerate(error):
        a, b = chunk_first[i], chunk_first[i + 1]
        to_chunk[a:b] = e * model.out[width:] / (b - a)
        to_chunk[a + both[a:b].argmax(axis=0), np.arange(width)] += e * model.out[:width]
    to_half = np.zeros((halves, width), np.float32)
    columns = np.broadcast_to(np.arange(width), side.shape)
    np.add.at(to_half, (np.where(side, chunk[:, 1:], chunk[:, :1]), columns), to_chunk)
    grad = to_half[:, :filters] * (raised > 0)
    out = [np.zeros_like(p) for p in model.parts]
    rows = np.arange(halves)[:, None]
    for k in range(WIDTH):
        byte = held[rows, where + k]
        seen = model.embed[byte]  # halves x filters x embedding
        out[1][k] = np.einsum("hfe,hf->ef", seen, grad)
        np.add.at(out[0], byte, grad[:, :, None] * model.filters[k].T[None])
    out[2] = grad.sum(axis=0)
    out[3] = (features.T @ error).astype(np.float32)
    out[4] = np.array([error.sum()], np.float32)
    return out


def fit(texts: list[bytes], labels: np.ndarray, training: Training = Training()) -> Model:
    """The network after ``epochs`` of Adam over the texts; the same input gives the same network."""
    model = new_model(training)
    rng = np.random.default_rng(training.seed)
    column = pa.array(texts, pa.binary())
    means = [np.zeros_like(p) for p in model.parts]
    squares = [np.zeros_like(p) for p in model.parts]
    step = 0
    known: dict[int, np.ndarray] = {}
    for epoch in range(training.epochs):
        rate = training.rate * (1 - epoch / training.epochs)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), training.batch):
            own = np.sort(order[at : at + training.batch])
            layout = lay_out(*buffers(column.take(pa.array(own))))
            if any(i not in known for i in own.tolist()):
                found = agreement(layout)
                for k, i in enumerate(own.tolist()):
                    known[i] = found[layout.first[k] : layout.first[k + 1]]
            agree = np.concatenate([known[i] for i in own.tolist()])
            step += 1
            for p, g, m, s in zip(model.parts, _gradients(layout, agree, labels[own], model), means, squares, strict=True):
                g = g + training.decay * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        model: Model = shared.value
        for block in blocks(batches, limit=BLOCK):
            yield block, [pa.array(scores(*buffers(texts_of(block)), model))]

    return run


def score_texts(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", prefix: str = "") -> DataFrame:
    """The columns ``keep`` of every row and its ``score``, after ``prefix``: the probability of label 1.

    Rows are scored one by one, without a shuffle, by all bytes of the text and nothing else: repeated rows get equal
    scores, null and empty texts the score of a text without content, texts of any length are read whole, chunk by chunk,
    other columns are ignored, an empty table gives no rows. One of ``keep`` that is named like the score asks for a prefix.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return mapped(docs, keep, text_col, "score double", _score(shared), prefix)


def train_classifier(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", training: Training = Training()
) -> Model:
    """The network for a table of labels 0 and 1 (other values and null ids are left out).

    Texts are gathered within the bounds of ``training``, those with the smallest id hashes, as many of either class;
    the label counts of the whole table then set the level, so that scores are probabilities. Without rows of both
    classes the score is the known class everywhere (0.5 without any).
    """
    one = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    short = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    short = short.where(F.octet_length(F.coalesce("text", F.lit(""))) <= training.text_bytes)
    counts = {r.label: r.n for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    gathered: list[tuple[bytes, int]] = []
    for label in sorted(counts):
        chosen = one.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(training.rows)
        rows = short.join(chosen, "id").orderBy(F.xxhash64("id"), "id").limit(training.rows).collect()
        gathered += [((r.text or "").encode(), label) for r in rows]
    seen = np.array([label for _, label in gathered], np.float32)
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    if len(set(seen.tolist())) < 2:
        model = new_model(training)
        model.out[:] = 0
        model.level[0] = 0 if not counts else 20 if share == 1 else -20 if share == 0 else np.log(share / (1 - share))
        return model
    model = fit([t for t, _ in gathered], seen, training)
    model.level[0] += np.log(share / (1 - share)) - np.log(seen.mean() / (1 - seen.mean()))
    return model
