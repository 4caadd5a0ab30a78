"""Removal of byte strings that occur elsewhere, by sorting suffixes where they can be equal.

A string of ``length`` bytes is removed wherever it stands if it starts at two or more places of the corpus. No task sees
the corpus, so suffixes are first brought together:

1. Every place's string picks an anchor, the k-gram in it with the smallest hash. Equal strings pick equal anchors at
   equal offsets, and neighbouring places mostly the same one: a run of places with one anchor is a row of a few numbers
   with the hashes of its anchor and of all its bytes.
2. Runs whose anchor occurs once have no repeats. Runs with equal bytes are repeats as a whole. Only where one anchor
   stands in different bytes are those fetched, one copy of each.
3. Per anchor the suffixes of these bytes are sorted (``suffixes``, deep-shallow) and equal neighbours found. An anchor
   with very many different surroundings is first dealt out again: each run is split by offset, and each part gets a
   longer anchor, the bytes that all its strings have in common. After a few rounds that is the whole string.
4. Covered bytes are merged per document and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import blocks, column_of, named, quoted, stored, texts_of
from tickbars.llm.spans import BYTE_VALUES, STEP, U64, buffers, mix
from tickbars.llm.suffixes import sort_suffixes

BLOCK = 1_000_000
PLACE_BITS = 24
INVERSE = U64(pow(int(STEP), -1, 1 << 64))


@dataclass(frozen=True)
class Repeats:
    """Strings of ``length`` bytes, anchors of ``gram`` bytes. Anchors with more than ``crowd`` runs are split by offset
    into ``parts``; ``sorted_places`` suffixes are sorted at once."""

    length: int = 400
    gram: int = 64
    crowd: int = 512
    parts: int = 8
    sorted_places: int = 400_000


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from every place that has as many."""
    n = len(data)
    if n < size:
        return np.zeros(0, U64)
    sums = np.zeros(n + 1, U64)
    np.cumsum(BYTE_VALUES[data] * _powers(STEP, n), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _powers(INVERSE, n - size + 1))


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every place the first smallest hash among the ``window`` hashes from there."""
    low = U64((1 << PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=U64)
    size = 1
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if window > size:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    return (least & low).astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray, plan: Repeats) -> dict[str, np.ndarray]:
    """Runs of places with one anchor: text, first and last place, anchor (all from the block's start), anchor hash."""
    window = plan.length - plan.gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < plan.length:
        return {"text": none, "first": none, "last": none, "anchor": none, "key": none}
    hashes = gram_hashes(data, plan.gram)
    anchor = anchors(hashes, window)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    fits = np.arange(len(anchor)) + plan.length <= offsets[1:][text]
    place = np.flatnonzero(fits)
    own, owner = anchor[place], text[place]
    begin = np.ones(len(place), bool)
    begin[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(begin)
    tails = np.append(heads[1:], len(place))[: len(heads)] - 1
    return {"text": owner[heads], "first": place[heads], "last": place[tails], "anchor": own[heads], "key": hashes[own[heads]].view(np.int64)}


def _pieces(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) parts of texts over the anchors' place range, overlapping so that no string is lost."""
    for i in range(len(offsets) - 1):
        for at in range(int(offsets[i]), max(int(offsets[i + 1]) - limit + 1, int(offsets[i]) + 1), 1 << (PLACE_BITS - 1)):
            yield i, at, min(at + (1 << (PLACE_BITS - 1)) + limit - 1, int(offsets[i + 1]))


def _find_runs(plan: Repeats):
    names = ["id", "print", "first", "last", "anchor", "key", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            data, offsets = buffers(texts_of(block))
            whole = data.tobytes()
            found = []
            if len(data) < 1 << (PLACE_BITS - 1):
                found.append(runs(data, offsets, plan))
            else:  # one very long text (a block has more than one only below its limit)
                for i, start, end in _pieces(data, offsets, plan.length):
                    part = runs(data[start:end], np.array([0, end - start]), plan)
                    found.append({"text": part["text"] + i, "key": part["key"], **{k: part[k] + start for k in ("first", "last", "anchor")}})
            for part in found:
                ends = (part["last"] + plan.length).tolist()
                body = [xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(part["first"].tolist(), ends, strict=True)]
                rows = pa.array(part["text"])
                base = offsets[:-1][part["text"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        column_of(block, "__id").take(rows),
                        column_of(block, "__print").take(rows),
                        *(pa.array(part[k] - base) for k in ("first", "last", "anchor")),
                        pa.array(part["key"], pa.int64()),
                        pa.array(np.array(body, U64).view(np.int64)),
                    ],
                    names=names,
                )

    return run


SLICE = "root long, body long, high long, low long, bytes binary, key long, surround long"


def _fetch(plan: Repeats):
    """Bytes of the runs asked for: ``high``/``low`` are the anchor's offsets in the first and last string."""
    names = [x.split()[0] for x in SLICE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            rows = []
            for text, asked in zip(texts_of(block).cast(pa.binary()).to_pylist(), column_of(block, "asked").to_pylist(), strict=True):
                for r in asked:
                    part = text[r["first"] : r["last"] + plan.length]
                    high, low = r["anchor"] - r["first"], r["anchor"] - r["last"]
                    rows.append((r["key"], r["body"], high, low, part, r["key"], r["body"]))
            yield _slices(rows, names)

    return run


def _slices(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _split(plan: Repeats, width: int):
    """Every run split at multiples of ``width`` offsets, the same ones in all runs, so that equal strings meet again.

    A part's key is the hash of the bytes around the anchor that all strings with such offsets have in common.
    """
    names = [x.split()[0] for x in SLICE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = []
                for r in batch.slice(start, 500).to_pylist():
                    raw, high = r["bytes"], r["high"]
                    for least in range(r["low"] // width * width, high + 1, width):
                        a, b = max(least, r["low"]), min(least + width - 1, high)
                        part = raw[high - b : high - a + plan.length]
                        common = raw[high - least : high - least - width + 1 + plan.length]
                        key = xxhash.xxh3_64_intdigest(least.to_bytes(4, "little") + common)
                        rows.append((r["root"], r["body"], b, a, part, _signed(key), _signed(xxhash.xxh3_64_intdigest(part, seed=a))))
                yield _slices(rows, names)

    return run


def _sort_groups(plan: Repeats):
    """Repeated offsets of the runs of whole anchors; batches arrive sorted by key."""
    names = ["root", "body", "high", "low"]

    def solve(held: list[dict]) -> pa.RecordBatch:
        joined = np.frombuffer(b"".join(r["bytes"] for r in held), np.uint8)
        sizes = np.array([r["high"] - r["low"] + 1 for r in held])
        base = np.cumsum([0, *(len(r["bytes"]) for r in held)])[:-1]
        row = np.repeat(np.arange(len(held)), sizes)
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        offset = np.array([r["high"] for r in held])[row] - step
        keys = np.unique(np.array([r["key"] for r in held]), return_inverse=True)[1]
        start = base[row] + step
        order, same = sort_suffixes(joined, start, keys[row] * (plan.length + 1) + offset, plan.length)
        hit = same.copy()
        hit[:-1] |= same[1:]
        twice = np.sort(order[hit])
        out = []
        if len(twice):
            lead = np.ones(len(twice), bool)
            lead[1:] = (np.diff(twice) != 1) | (row[twice[1:]] != row[twice[:-1]])
            heads = np.flatnonzero(lead)
            tails = np.append(heads[1:], len(twice)) - 1
            for a, b in zip(twice[heads].tolist(), twice[tails].tolist(), strict=True):
                r = held[row[a]]
                out.append((r["root"], r["body"], int(offset[a]), int(offset[b])))
        columns = zip(*out, strict=True) if out else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        places = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                for r in batch.slice(start, 500).to_pylist():
                    if held and places >= plan.sorted_places and r["key"] != held[-1]["key"]:
                        yield solve(held)
                        held, places = [], 0
                    held.append(r)
                    places += r["high"] - r["low"] + 1
        if held:
            yield solve(held)

    return run


def _cut(plan: Repeats, names: list[str]):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            sizes, gone, kept = [], [], []
            for text, spans in zip(texts_of(block).cast(pa.binary()).to_pylist(), column_of(block, "spans").to_pylist(), strict=True):
                merged: list[list[int]] = []
                for s in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                stops = [0, *(x for m in merged for x in m), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(stops[::2], stops[1::2], strict=True)))
                sizes.append(len(text))
                gone.append([{"start": a, "end": b} for a, b in merged])
            columns = [pa.array(sizes, pa.int64()), pa.array(gone, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([column_of(block, "__id"), *columns], names=names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Repeats = Repeats()) -> DataFrame:
    """``id_col, n_bytes, removed, kept`` of every row: bytes of the text, spans ``(start, end)`` taken out, and the rest.

    Texts are UTF-8 bytes, and so is the rest, which may begin or end within a character. Every byte is taken out that a
    string of ``length`` bytes covers which also starts anywhere else, in this row or another; strings are judged on the
    input. Repeated rows hold each other's strings; rows that share an id only are told apart by their text. Null and
    empty texts, and ones shorter than ``length``, stay as they are; texts of any length are judged whole; of several equal
    places none is spared, so ties don't matter; null ids are ids; other columns are ignored; an
    empty table gives no rows.

    Texts are shuffled twice by id, and beside them a row of a few numbers for every run (about one in 170 bytes). Counts
    per anchor are formed before the shuffle; joins on anchors can be split; and no task holds more runs of one anchor
    than ``crowd``.
    """
    picked = docs.select(named(id_col).alias("__id"), named(text_col).cast("string").alias("__text"))
    picked = picked.withColumn("__print", F.xxhash64("__text"))
    kind = picked.schema["__id"].dataType.simpleString()

    row = f"id {kind}, print long, first long, last long, anchor long, key long, body long"
    every = stored(picked.mapInArrow(_find_runs(plan), row), "runs")
    shared = every.groupBy("key").agg(F.count("*").alias("n"), F.min("body").alias("low"), F.max("body").alias("high"))
    # Stored before a join, an aggregate is one more plain side of it, and the side of a hot anchor can be split.
    shared = stored(shared.where("n > 1").select("key", (F.col("low") != F.col("high")).alias("mixed")), "shared-keys")
    found = stored(every.join(shared, "key"), "shared-runs")

    place = F.struct("id", "print", "first", "last", "anchor")
    bodies = found.groupBy("key", "body").agg(F.count("*").alias("n"), F.min(place).alias("one"), F.max("mixed").alias("mixed"))
    bodies = stored(bodies, "bodies")
    asked = bodies.where("mixed").groupBy(F.col("one.id").alias("id"), F.col("one.print").alias("print"))
    asked = asked.agg(F.collect_list(F.struct("one.first", "one.last", "one.anchor", "key", "body")).alias("asked"))
    same_row = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__print") == F.col("print"))
    # A repeated row brings a run's bytes several times; that run is a repeat as a whole anyway.
    texts = picked.join(asked, same_row).select("__text", "asked")
    slices = texts.mapInArrow(_fetch(plan), SLICE)

    answers = bodies.where("n > 1").select(F.col("key").alias("root"), "body", F.lit(None).cast("long").alias("high"), F.lit(None).cast("long").alias("low"))
    width = plan.length - plan.gram + 1
    while True:
        slices = stored(slices, "slices")
        groups = slices.groupBy("key").agg(F.count("*").alias("n"), F.min("surround").alias("least"), F.max("surround").alias("most"))
        groups = stored(groups.where("n > 1"), "groups")
        few = slices.join(groups.where(F.col("n") <= plan.crowd).select("key"), "key", "semi")
        few = few.select("root", "body", "high", "low", "bytes", "key").repartition("key").sortWithinPartitions("key")
        answers = answers.unionByName(few.mapInArrow(_sort_groups(plan), "root long, body long, high long, low long"))
        crowds = groups.where(F.col("n") > plan.crowd)
        alike = slices.join(crowds.where("least = most").select("key"), "key", "semi")
        answers = answers.unionByName(alike.select("root", "body", "high", "low"))
        crowds = crowds.where("least <> most")
        if crowds.isEmpty():
            break
        width = -(-width // plan.parts)
        slices = slices.join(crowds.select("key"), "key", "semi").mapInArrow(_split(plan, width), SLICE)

    parts = F.collect_list(F.struct("high", "low")).alias("parts")
    per = answers.distinct().groupBy("root", "body").agg(F.max(F.col("high").isNull()).alias("whole"), parts)
    per = stored(per, "answers")
    spans = found.join(per.withColumnRenamed("root", "key"), ["key", "body"]).select(
        "id",
        "print",
        F.expr(
            f"""CASE WHEN whole THEN array(struct(first AS start, last + {plan.length} AS end))
            ELSE transform(parts, p -> struct(anchor - p.high AS start, anchor - p.low + {plan.length} AS end)) END"""
        ).alias("spans"),
    )
    spans = spans.groupBy("id", "print").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    joined = picked.join(spans, same_row, "left").select("__id", "__text", "spans")
    names = [id_col, "n_bytes", "removed", "kept"]
    schema = f"{quoted(id_col)} {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(_cut(plan, names), schema)
