"""Line dedup over content-defined chunks of lines.

Only lines that aren't blank count. A rolling hash over two neighbouring lines says, under each of several rules, whether a
chunk opens at the first or closes at the second of them. A chunk's borders so depend on its own lines only, and the same
passage is cut in the same way wherever it stands; chunks of different rules overlap. A chunk that occurs in more than one
place of the corpus stays in the first place (smallest id, then position). Elsewhere its bytes are compared with the first
place's, and a confirmed hit grows line by line to both sides as long as the lines there equal those beside the first place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import blocks, column_of, named, quoted, stored, texts_of
from tickbars.llm.spans import BYTE_VALUES, SPACES, STEP, U64, buffers, mix, seeded, span_hashes

NEWLINE = 10


@dataclass(frozen=True)
class Cutting:
    """Under each of ``rules``, one in ``opens`` line pairs opens a chunk and all but one in ``passes`` close one. Two given
    lines are a chunk by themselves under some rule with a chance of 94 %."""

    rules: int = 5
    opens: int = 2
    passes: int = 8


#: Lines that a hit can grow to either side. Chunks overlap so much that more are never found in practice.
REACH = 2


@dataclass
class Lines:
    """Lines of a block of texts that aren't blank: byte spans, text of each, and each text's range of lines."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray


def find_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    breaks = np.flatnonzero(data == NEWLINE)
    rows = np.flatnonzero(np.diff(offsets))
    start = np.sort(np.concatenate([offsets[rows], breaks + 1]))
    # A text's last line ends with the text; a break there leaves an empty line after it, which is blank.
    end = np.sort(np.concatenate([breaks, offsets[rows + 1]]))
    said = np.append(0, np.cumsum(~SPACES[data]))
    order = np.flatnonzero(said[end] > said[np.minimum(start, end)])
    start, end = start[order], end[order]
    text = np.searchsorted(offsets, start, "right") - 1
    return Lines(start, end, text, np.searchsorted(text, np.arange(len(offsets))))


@dataclass
class Chunks:
    """Chunks of a block: first line, number of lines (among all lines of the block)."""

    line: np.ndarray
    lines: np.ndarray


def cut(data: np.ndarray, found: Lines, cutting: Cutting) -> Chunks:
    hashes = span_hashes(data, found.start, found.end, BYTE_VALUES)
    n = len(hashes)
    if n < 2:
        return Chunks(np.zeros(0, np.int64), np.zeros(0, np.int64))
    rolling = mix(hashes[:-1] * STEP + hashes[1:])
    whole = found.text[:-1] == found.text[1:]
    at = np.arange(n - 1)
    opening, closing = seeded(cutting.rules, 21), seeded(cutting.rules, 22)
    keys = []
    for k in range(cutting.rules):
        opens = whole & (mix(rolling ^ opening[k]) % U64(cutting.opens) == 0)
        closes = whole & (mix(rolling ^ closing[k]) % U64(cutting.passes) != 0)
        ends = np.minimum.accumulate(np.where(closes, at, n)[::-1])[::-1]
        i = np.flatnonzero(opens & (ends < n))
        i = i[found.text[ends[i]] == found.text[i]]
        keys.append(i * n + ends[i] - i)
    key = np.unique(np.concatenate(keys))
    return Chunks(key // n, key % n + 2)


def _wide_hash(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _chunk_hashes(cutting: Cutting):
    names = ["id", "print", "number", "lines", "hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = buffers(texts_of(block))
            found = find_lines(data, offsets)
            chunks = cut(data, found, cutting)
            raw = data.tobytes()
            spans = zip(found.start[chunks.line].tolist(), found.end[chunks.line + chunks.lines - 1].tolist(), strict=True)
            hashes = [_wide_hash(raw[a:b]) for a, b in spans]
            text = found.text[chunks.line]
            whose = [column_of(block, c).take(pa.array(text)) for c in ("__id", "__print")]
            numbers = [pa.array(x.astype(np.int32)) for x in (chunks.line - found.first[text], chunks.lines)]
            yield pa.RecordBatch.from_arrays([*whose, *numbers, pa.array(hashes, pa.binary())], names=names)

    return run


CHUNK = "number int, lines int, hash binary"
BESIDE = [f"{side}{k}" for side in ("up", "down") for k in range(1, REACH + 1)]


def _chunk_bytes():
    """The bytes of the chunks asked for in ``places`` (number, lines, hash, first), where the text still has them, and
    128-bit digests of the lines beside them with what lies in between."""
    names = ["id", "print", "number", "lines", "hash", "first", "bytes", *BESIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = buffers(texts_of(block))
            found = find_lines(data, offsets)
            raw = data.tobytes()
            rows, owners = [], []
            for i, places in enumerate(column_of(block, "places").to_pylist()):
                begin, stop = found.first[i : i + 2].tolist()
                start, end = found.start[begin:stop].tolist(), found.end[begin:stop].tolist()
                for p in places:
                    a, b = p["number"], p["number"] + p["lines"] - 1
                    part = raw[start[a] : end[b]] if b < len(end) else b""
                    if _wide_hash(part) == p["hash"]:
                        up = [_wide_hash(raw[start[a - k] : start[a - k + 1]]) if a >= k else None for k in range(1, REACH + 1)]
                        down = [_wide_hash(raw[end[b + k - 1] : end[b + k]]) if b + k < len(end) else None for k in range(1, REACH + 1)]
                        rows.append((p["number"], p["lines"], p["hash"], p["first"], part, *up, *down))
                        owners.append(i)
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.bool_(), *[pa.binary()] * (1 + len(BESIDE))]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            whose = [column_of(block, c).take(pa.array(owners, pa.int64())) for c in ("__id", "__print")]
            yield pa.RecordBatch.from_arrays([*whose, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)

    return run


def _grown(side: str) -> str:
    """How many lines beside a chunk equal those beside its first place."""
    out = "0"
    for k in range(REACH, 0, -1):
        out = f"CASE WHEN {side}{k} = kept.{side}{k} THEN {f'1 + {out}' if k < REACH else 1} ELSE 0 END"
    return out


def lines_out(n: int, hits: list[dict], firsts: list[dict]) -> list[tuple[int, int]]:
    """Ranges of the lines of a text that go, in order.

    Hits that lie beside the same place in the same way are one run. Longer runs come first; a run loses the lines that are
    gone already or belong to the first place of a repeated chunk, and of the rest every two lines or more go. So nothing
    goes that is stitched together from single lines of several places, and every removed chunk is left whole somewhere.
    """
    kept, gone = np.zeros(n, bool), np.zeros(n, bool)
    for f in firsts:
        kept[f["number"] : f["number"] + f["lines"]] = True
    spans = sorted((h["source"], h["shift"], h["number"] - h["up"], h["number"] + h["lines"] + h["down"]) for h in hits)
    runs: list[list] = []
    for source, shift, a, b in spans:
        if runs and runs[-1][:2] == [source, shift] and a <= runs[-1][3]:
            runs[-1][3] = max(runs[-1][3], b)
        else:
            runs.append([source, shift, a, b])
    for _, _, a, b in sorted(runs, key=lambda r: (r[2] - r[3], r[2], r[0], r[1])):
        free = np.concatenate([[False], ~(kept[a:b] | gone[a:b]), [False]])
        edges = np.flatnonzero(free[1:] != free[:-1]) + a
        for c, d in edges.reshape(-1, 2).tolist():
            if d - c > 1:
                gone[c:d] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return [tuple(x) for x in edges.reshape(-1, 2).tolist()]


def _rewrite(cutting: Cutting, fields: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = buffers(texts_of(block))
            found = find_lines(data, offsets)
            chunks = cut(data, found, cutting)
            many = np.bincount(found.text[chunks.line], minlength=len(offsets) - 1).tolist()
            breaks = np.append(0, np.cumsum(data == NEWLINE))
            raw = data.tobytes()
            texts = column_of(block, "__text").to_pylist()
            counts = []
            for i, marks in enumerate(column_of(block, "marks").to_pylist()):
                a, b = int(offsets[i]), int(offsets[i + 1])
                all_lines = int(breaks[b] - breaks[a]) + (b > a)
                begin, stop = found.first[i : i + 2].tolist()
                start, end = found.start[begin:stop].tolist(), found.end[begin:stop].tolist()
                same = []
                for m in marks or ():
                    last = m["number"] + m["lines"] - 1
                    if last < len(end) and _wide_hash(raw[start[m["number"]] : end[last]]) == m["hash"]:
                        same.append(m)
                hits = [m for m in same if m["source"] is not None]
                cuts = lines_out(stop - begin, hits, [m for m in same if m["source"] is None]) if hits else []
                removed = 0
                if cuts:
                    parts, at = [], a
                    for c, d in cuts:
                        upto = min(end[d - 1] + 1, b)
                        parts.append(raw[at : start[c]])
                        removed += int(breaks[end[d - 1]] - breaks[start[c]]) + 1
                        at = upto
                    left = b"".join([*parts, raw[at:b]])
                    if not left.strip(b" \t\n\r\x0b\x0c"):
                        left, removed = b"", all_lines
                    texts[i] = left.decode()
                counts.append((all_lines, many[i], len({(h["number"], h["lines"]) for h in hits}), removed))
            made = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            kept = [pa.array(texts, pa.string()) if f == "__text" else column_of(block, f) for f in fields]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return run


def drop_repeated_chunks(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id", "text"),
    id_col: str = "doc_id",
    text_col: str = "text",
    cutting: Cutting = Cutting(),
    prefix: str = "",
) -> DataFrame:
    """The columns ``keep`` of every row, its text without repeated chunks, and after ``prefix`` the counts
    ``n_lines, n_chunks, n_removed_chunks, n_removed_lines``.

    Lines end at ``\\n``; blank ones belong to no chunk by themselves and go only from between removed lines, or where
    nothing else is left. A chunk has two lines or more, so a single repeated line between lines of its own stays, and texts
    of one line are left alone. A chunk that stands in several places, in one document or many, stays where id and position
    are smallest (a null id is smaller than any other); ties within a text are settled by ``lines_out``.

    Rows that share id and text are one document: their chunks aren't repeats of each other. Rows that share an id only
    are documents of their own, in an order fixed by a hash of the text. Texts of any length are cut whole. Null texts stay
    null, empty ones empty; an empty table gives no rows; other columns are ignored, and one of ``keep`` that is named like a
    count asks for a prefix.

    Hashes are aggregated before the shuffle, so a chunk in a third of all documents costs a row per task; texts move by
    id, and chunk bytes only of repeated chunks. Runs jobs while it is built.
    """
    made = [prefix + n for n in ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")]
    if set(made) & set(keep):
        raise ValueError(f"{sorted(set(made) & set(keep))}: choose a prefix")
    own = ["__text" if c == text_col else "__id" if c == id_col else f"__keep{k}" for k, c in enumerate(keep)]
    columns = {"__id": id_col, "__text": text_col, **dict(zip(own, keep, strict=True))}
    picked = docs.select(*(named(c).cast("string").alias(f) if f == "__text" else named(c).alias(f) for f, c in columns.items()))
    kinds = {f.name: f.dataType.simpleString() for f in picked.schema}
    # Rows that share an id only are told apart by a hash of the text.
    picked = picked.withColumn("__print", F.xxhash64("__text"))
    only = picked.select("__id", "__print", "__text")
    own_row = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__print") == F.col("print"))

    chunk = f"id {kinds['__id']}, print long, {CHUNK}"
    places = stored(only.mapInArrow(_chunk_hashes(cutting), chunk), "chunks")
    place = F.struct("id", "print", "number")
    repeated = places.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = repeated.where(~F.col("first").eqNullSafe(F.col("last"))).select("hash", "first")
    # Stored before a join, an aggregate is one more plain side of it, and the side of a hot chunk can be split.
    repeated = stored(repeated, "repeated-chunks")
    asked = places.join(repeated, "hash").withColumn("is_first", place.eqNullSafe(F.col("first")))
    asked = asked.groupBy("id", "print").agg(F.collect_set(F.struct("number", "lines", "hash", F.col("is_first").alias("first"))).alias("places"))
    bodies = only.join(asked, own_row).drop("id", "print")
    schema = ", ".join([chunk, "first boolean, bytes binary", *(f"{c} binary" for c in BESIDE)])
    copies = stored(bodies.mapInArrow(_chunk_bytes(), schema), "chunk-bytes")
    whose = [F.xxhash64("id", "print").alias("source"), F.col("number").alias("at")]
    kept = copies.where("first").groupBy("hash").agg(F.first(F.struct("bytes", *BESIDE, *whose)).alias("kept"))
    hits = copies.where("NOT first").join(stored(kept, "kept-chunks"), "hash").where("bytes = kept.bytes")
    mark = ["id", "print", "number", "lines", "hash"]
    hits = hits.select(*mark, "kept.source", F.expr("number - kept.at AS shift"), *(F.expr(f"{_grown(s)} AS {s}") for s in ("up", "down")))
    firsts = copies.where("first").select(*mark, F.lit(None).cast("long").alias("source"), *(F.lit(None).cast("int").alias(c) for c in ("shift", "up", "down")))
    marks = hits.unionByName(firsts).groupBy("id", "print")
    marks = marks.agg(F.collect_set(F.struct("number", "lines", "hash", "source", "shift", "up", "down")).alias("marks"), F.max("source").alias("any"))
    joined = picked.join(marks.where("any IS NOT NULL").drop("any"), own_row, "left").drop("id", "print")
    schema = ", ".join([*(f"{quoted(c)} {kinds[f]}" for c, f in zip(keep, own, strict=True)), *(f"{quoted(m)} long" for m in made)])
    return joined.mapInArrow(_rewrite(cutting, own, [*keep, *made]), schema)
