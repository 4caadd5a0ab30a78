"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are the windows of ``window`` consecutive words of benchmark items (a shorter item is one window). Strings
of one length share a block-shift table: for the last two words under the current place it tells how far the place can
move on because no string has that block nearer to its end. Only where the shift is zero are the strings looked up, by
their last block and first word, and compared directly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import blocks, mapped, named, texts_of

#: A-Z to a-z, every other ASCII byte outside 0-9 and a-z to a space; bytes of longer characters stay.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

#: Bytes of benchmark text whose tables are broadcast at once; a larger benchmark is searched in blocks.
TABLE_BYTES = 4_000_000

FOUND = "n_words long; n_hit long; spans array<struct<start:long,end:long>>; items array<string>; contaminated boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class WuManber:
    """Search tables for the strings of one length in words."""

    def __init__(self, length: int, strings: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[bytes, list[str]]]]] = defaultdict(lambda: defaultdict(list))
        for string, items in strings.items():
            for end in range(self.block, length + 1):
                key = b" ".join(string[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets[b" ".join(string[-self.block :])][string[0]].append((b" ".join(string), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, end, items) of every occurrence."""
        length, default, shift = self.length, self.default, self.shift
        pair, n, at = self.block == 2, len(words), self.length - 1
        while at < n:
            block = words[at - 1] + b" " + words[at] if pair else words[at]
            step = shift.get(block, default)
            if step:
                at += step
                continue
            start = at - length + 1
            near = self.buckets[block].get(words[start])
            if near:
                here = b" ".join(words[start : at + 1])
                for string, items in near:
                    if string == here:
                        yield start, at + 1, items
            at += 1


def build(items: list[tuple[str | None, str | None]], window: int) -> list[WuManber]:
    """Tables for benchmark items given as (id, text)."""
    strings: dict[int, dict[tuple[bytes, ...], dict[str, None]]] = defaultdict(dict)
    for item, text in items:
        words = words_of((text or "").encode())
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            owners = strings[size].setdefault(tuple(words[k : k + size]), {})
            if item is not None:
                owners[item] = None
    return [WuManber(n, {k: list(v) for k, v in found.items()}) for n, found in strings.items()]


def find(tables: list[WuManber], words: list[bytes]) -> tuple[list[list[int]], set[str]]:
    """(merged word spans, items) of all occurrences."""
    hits: list[tuple[int, int]] = []
    items: set[str] = set()
    for table in tables:
        for start, end, owners in table.search(words):
            if hits and start <= hits[-1][1] and hits[-1][0] <= start:
                hits[-1] = (hits[-1][0], max(end, hits[-1][1]))
            else:
                hits.append((start, end))
            items.update(owners)
    return merged(hits), items


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _search(shared, window: int, percent: int, text_col: str, earlier: str | None):
    struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        tables = build(shared.value, window)
        for block in blocks(batches):
            texts = texts_of(block).cast(pa.binary()).to_pylist()
            before = block.column(block.schema.get_field_index(earlier)).to_pylist() if earlier else [None] * len(texts)
            rows = []
            for text, old in zip(texts, before, strict=True):
                words = words_of(text)
                spans, items = find(tables, words)
                if old:
                    spans = merged([*map(tuple, spans), *((s["start"], s["end"]) for s in old["spans"])])
                    items |= set(old["items"])
                hit = sum(b - a for a, b in spans)
                found = [{"start": a, "end": b} for a, b in spans]
                rows.append((len(words), hit, found, sorted(items), hit > 0 and 100 * hit >= percent * len(words)))
            kinds = [pa.int64(), pa.int64(), struct, pa.list_(pa.string()), pa.bool_()]
            yield block, [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]

    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple]]:
    """The benchmark as (id, text) lists of ``limit`` bytes of text each (or one longer item)."""
    held: list[tuple] = []
    size = 0
    picked = benchmark.select(named(item_col).cast("string").alias("item"), named(text_col).cast("string").alias("text"))
    for row in picked.where("text IS NOT NULL").distinct().toLocalIterator():
        n = len(row.text.encode())
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append((row.item, row.text))
        size += n
    yield held


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    percent: int = 5,
    prefix: str = "",
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """The columns ``keep`` of every row and what its text shares with the benchmark, each name after ``prefix``.

    ``n_words, n_hit, spans, items, contaminated``: words, words inside an occurrence, their merged word spans, the ids
    of items with an occurring window (as strings, sorted, distinct), and whether the hit words are ``percent`` of all.
    Words are runs of 0-9, a-z and characters beyond ASCII after A-Z became a-z.

    Documents are never shuffled. Tables for ``table_bytes`` of benchmark text are broadcast at a time; a larger
    benchmark makes several passes in one plan, each adding to the findings of the one before.

    Null or empty texts have no words; empty items match nothing; a null item id counts as a hit without a name; repeated
    rows give repeated results, and texts that tie in their share equal ones; texts of any length are searched whole; other
    columns are ignored; an empty table or benchmark gives no hits.
    """
    spark = docs.sparkSession
    made = [prefix + x.split()[0] for x in FOUND.split("; ")]
    if set(made) & set(keep):
        raise ValueError(f"{sorted(set(made) & set(keep))}: choose a prefix")
    fields = [f"__{k}" for k in range(len(keep))]
    frame = docs.select(*(named(c).alias(f) for c, f in zip(keep, fields, strict=True)), named(text_col).cast("string").alias("__body"))
    carried: list[str] = []
    for items in benchmark_blocks(benchmark, item_col, item_text_col, table_bytes):
        shared = spark.sparkContext.broadcast(items)
        earlier = f"__keep{len(fields) + 1}" if carried else None
        frame = mapped(frame, (*fields, "__body", *carried), "__body", FOUND, _search(shared, window, percent, text_col, earlier), "__found_")
        found = [f"__found_{x.split()[0]}" for x in FOUND.split("; ")]
        frame = frame.select(*fields, "__body", F.struct(*(F.col(f).alias(f.removeprefix("__found_")) for f in found)).alias("__earlier"))
        carried = ["__earlier"]
    names = [x.split()[0] for x in FOUND.split("; ")]
    return frame.select(*(F.col(f).alias(c) for c, f in zip(keep, fields, strict=True)), *(F.col(f"__earlier.{n}").alias(prefix + n) for n in names))
