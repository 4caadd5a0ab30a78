"""Alignment of two tokenizers over the bytes of each text.

Both tokenizers cut the same bytes, so their tokens have cumulative byte ends. These are intersected by a dictionary from
end to token index; the sorted common ends slice both id lists into groups, and within a slice tokens are linked where their
byte ranges overlap.

How many documents hold a pair of ids linked is a figure of the whole corpus. Tasks work on blocks of some megabytes of
text: a block has one row with its distinct pairs and their document counts, and a document only the places of its own
pairs in that list, as gaps in few bytes. Pairs are summed and meet the blocks again per (block, pair), not per document,
so neither the vocabularies' product nor a pair that stands everywhere is held in one place.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickbars.llm.shared import blocks, column_of, named, quoted, stored, texts_of
from tickbars.llm.spans import buffers
from tickbars.llm.tokens import OUTSIDE, byte_letters

#: Bytes of text whose pairs share one list, and bytes that are tokenized in one go.
BLOCK, STRETCH = 16_000_000, 1_000_000
#: Texts beyond this length, in characters, are left to the library's own splitter, which needs no deep regex stack.
LONG = 1_000_000
#: Bytes of one text whose ends are in dictionaries at once.
WINDOW = 1 << 20
MARK = "▁"


class ByteLevel:
    """Ids of a byte-level BPE file, special strings being plain text.

    Where every merge makes the next id, ids are ranks and the file's merges run in ``tiktoken``; texts with characters
    whose Unicode classes may be of different age in the two libraries, and very long ones, go through ``tokenizers``.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, source: str):
        spec = json.loads(source)
        self.library = Tokenizer.from_str(source)
        self.library.encode_special_tokens = True
        back = {letter: b for b, letter in enumerate(byte_letters())}
        special = {x["content"] for x in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.bytes = {i: bytes(back[c] for c in entry) for entry, i in vocab.items() if entry not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        made = [vocab[m.replace(" ", "")] for m in merges]
        plain = spec.get("normalizer") is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"].get("add_prefix_space")
        self.fast = None
        if plain and made == list(range(256, 256 + len(made))) and len(self.bytes) == 256 + len(made):
            ranks = {b: i for i, b in self.bytes.items()}
            self.fast = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        slow = [i for i, t in enumerate(texts) if self.fast is None or len(t) > LONG or OUTSIDE.search(t)]
        own = set(slow)
        out = [None if i in own else self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for i, t in enumerate(texts)]
        for i, found in zip(slow, self.library.encode_batch([texts[i] for i in slow], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, np.int64)
        return out


class Pieces:
    """Ids of a sentencepiece model, and the bytes of its pieces: the mark as a space, byte pieces as their byte."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


class Table:
    """The byte strings of a vocabulary as a column."""

    def __init__(self, entries: dict[int, bytes]):
        if not all(entries.values()):
            raise ValueError("a vocabulary entry without bytes can't be aligned")
        self.size = max(entries) + 1
        self.column = pa.array([entries.get(i, b"") for i in range(self.size)], pa.large_binary())
        self.lengths = np.array([len(entries.get(i, b"")) for i in range(self.size)], np.int64)

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        return buffers(self.column.take(pa.array(ids)))[0]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of either list that end at a byte where a token of the other list ends, too.

    B's ends are the keys of a dictionary to their indexes; A's ends, which ascend as their indexes do, are looked up in it.
    """
    last_a, last_b = [], []
    total = int(ends_a[-1]) if len(ends_a) else 0
    borders = [*range(0, total, WINDOW), total]
    cuts_a, cuts_b = (np.searchsorted(e, borders, side="right").tolist() for e in (ends_a, ends_b))
    for a0, a1, b0, b1 in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:]):
        index_of = dict(zip(ends_b[b0:b1].tolist(), range(b0, b1), strict=True))
        found = np.fromiter(map(index_of.get, ends_a[a0:a1].tolist(), repeat(-1)), np.int64, a1 - a0)
        shared = np.flatnonzero(found >= 0)
        last_a.append(shared + a0)
        last_b.append(found[shared])
    whole_a, whole_b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (last_a, last_b))
    return whole_a, whole_b


def linked(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (a, b) of all tokens whose byte ranges overlap, slice by slice."""
    first_a, first_b = np.append(0, last_a + 1)[:-1], np.append(0, last_b + 1)[:-1]
    n_a, n_b = last_a - first_a + 1, last_b - first_b + 1
    plain = (n_a == 1) | (n_b == 1)
    many = (n_a * n_b)[plain]
    within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    a = np.repeat(first_a[plain], many) + np.where(np.repeat(n_b[plain], many) == 1, within, 0)
    b = np.repeat(first_b[plain], many) + np.where(np.repeat(n_a[plain], many) == 1, within, 0)
    if plain.all():
        return a, b
    # Slices of several tokens on both sides: each stretch between two ends of either list lies in one token of both.
    inner = [ranges(f[~plain], n[~plain]) for f, n in ((first_a, n_a), (first_b, n_b))]
    ends = np.union1d(ends_a[inner[0]], ends_b[inner[1]])
    return np.append(a, np.searchsorted(ends_a, ends)), np.append(b, np.searchsorted(ends_b, ends))


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (n[0] of them), first[1], ..."""
    return np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)


def packed(values: np.ndarray) -> bytes:
    """Positive numbers, seven bits a byte, the last byte of each with its high bit."""
    n = 1 + sum((values >= 1 << (7 * k)).astype(np.int64) for k in range(1, 9))
    place = ranges(np.zeros(len(n), np.int64), n)
    out = (np.repeat(values, n) >> (7 * place)) & 127
    out[np.cumsum(n) - 1] |= 128
    return out.astype(np.uint8).tobytes()


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data & 128) + 1
    n = np.diff(ends, prepend=0)
    if not len(n):
        return np.zeros(0, np.int64)
    terms = (data & 127).astype(np.int64) << (7 * ranges(np.zeros(len(n), np.int64), n))
    return np.add.reduceat(terms, ends - n)


class Aligner:
    """Two tokenizers and what one text gives."""

    def __init__(self, source: str, model: bytes):
        self.coders = ByteLevel(source), Pieces(model)
        self.tables = tuple(Table(c.bytes) for c in self.coders)
        sizes = [t.size for t in self.tables]
        words = [f"{i}{end}" for size, ends in zip(sizes, (",|", ",;"), strict=True) for end in ends for i in range(size)]
        self.words = pa.array(words, pa.large_string())
        self.base = np.cumsum([0, sizes[0], sizes[0], sizes[1]])

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Both id lists of each text; none for empty texts and texts that a tokenizer doesn't keep byte by byte."""
        spaced = [" " + t for t in texts]
        ids = [coder.encode(given) for coder, given in zip(self.coders, (spaced, texts), strict=True)]
        same = [bool(t) for t in texts]
        for table, lists in zip(self.tables, ids, strict=True):
            data = table.spelt(np.concatenate(lists))
            ends = np.cumsum([int(table.lengths[x].sum()) for x in lists]).tolist()
            start = 0
            for i, end in enumerate(ends):
                if same[i]:
                    same[i] = data[start:end].tobytes() == spaced[i].encode()
                start = end
        for i, ok in enumerate(same):
            yield (ids[0][i], ids[1][i]) if ok else None

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[int, str, np.ndarray]:
        """(groups, their digest, the id pair of each link as ``a * size of B + b``)."""
        ends_a, ends_b = np.cumsum(self.tables[0].lengths[a]), np.cumsum(self.tables[1].lengths[b])
        last_a, last_b = common_ends(ends_a, ends_b)
        link_a, link_b = linked(ends_a, ends_b, last_a, last_b)
        # Groups as text: A's ids of a slice, then B's, each id with the sign that follows it.
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        place = np.empty(len(a) + len(b), np.int64)
        signed_a, signed_b = a + self.base[0], b + self.base[2]
        signed_a[last_a] = a[last_a] + self.base[1]
        signed_b[last_b] = b[last_b] + self.base[3]
        place[np.arange(len(a)) + np.repeat(np.cumsum(n_b) - n_b, n_a)] = signed_a
        place[np.arange(len(b)) + np.repeat(np.cumsum(n_a), n_b)] = signed_b
        text = buffers(self.words.take(pa.array(place)))[0]
        return len(last_a), hashlib.sha256(text[:-1].data).hexdigest(), a[link_a] * self.tables[1].size + b[link_b]


MADE = "block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs array<bigint>, n_docs array<bigint>"


class _Block:
    """The documents of a block and their pairs."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.rows: list[pa.Array] = []
        self.found: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: pa.Array, results: list[tuple | None]) -> None:
        self.rows.append(ids)
        for r in results:
            pairs, times = (np.zeros(0, np.int64),) * 2 if r is None else np.unique(r[4], return_counts=True)
            self.found.append((0, 0, 0, 0, "") if r is None else (r[0], r[1], r[2], len(r[4]), r[3]))
            self.pairs.append(pairs)
            self.times.append(times)

    def out(self, kind: pa.DataType) -> pa.RecordBatch:
        every, inverse, counts = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")  # frequent pairs first, so that gaps are small
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[inverse]
        places, more, start = [], [], 0
        for times in self.times:
            own = at[start : start + len(times)]
            start += len(times)
            by = np.argsort(own)
            again = times[by] > 1
            places.append(packed(2 * np.diff(own[by], prepend=-1) + again))
            more.append(packed(times[by][again]))
        n = len(self.found)
        ids = pa.concat_arrays([*self.rows, pa.nulls(1, kind)])
        columns = [ids, pa.array([self.number] * (n + 1), pa.int64())]
        columns += [pa.array([*(r[i] for r in self.found), None], pa.int64()) for i in range(4)]
        columns += [pa.array([*(r[4] for r in self.found), None], pa.string())]
        columns += [pa.array([*x, None], pa.binary()) for x in (places, more)]
        offsets = pa.array([0] * (n + 1) + [len(every)], pa.int32())
        gone = pa.array([True] * n + [False])
        columns += [pa.ListArray.from_arrays(offsets, pa.array(x), mask=gone) for x in (every[order], counts[order])]
        return pa.RecordBatch.from_arrays(columns, names=["id", *(x.split()[0] for x in MADE.split(", "))])


_ALIGNERS: dict[bytes, Aligner] = {}


def _aligner(source: str, model: bytes) -> Aligner:
    """One per Python worker, which serves many tasks."""
    key = hashlib.sha256(source.encode() + model).digest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(source, model)
    return _ALIGNERS[key]


def _align(shared, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for batch in blocks(batches, limit=STRETCH):
            texts = texts_of(batch).to_pylist()
            results: list[tuple | None] = []
            for ids in aligner.tokens(texts):
                results.append(None if ids is None else (len(ids[0]), len(ids[1]), *aligner.align(*ids)))
            block.add(column_of(batch, "id"), results)
            block.size += sum(map(len, texts))
            if block.size >= BLOCK:
                yield block.out(kind)
                block = _Block(block.number + 1)
        if block.found:
            yield block.out(kind)

    return run


def _score(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block, from the counts of the block's pairs."""
    n = counts.num_rows
    at = counts.column("place").to_numpy()
    figures = np.zeros((2, n), np.int64)
    figures[0, at] = counts.column("n").to_numpy()
    figures[1, at] = counts.column("best").to_numpy()
    best, total = [], []
    for places, more in zip(*(docs.column(c).to_pylist() for c in ("places", "times")), strict=True):
        codes = unpacked(np.frombuffer(places, np.uint8))
        own = np.cumsum(codes >> 1) - 1
        times = np.ones(len(own), np.int64)
        times[(codes & 1) == 1] = unpacked(np.frombuffer(more, np.uint8))
        total.append(int((figures[0, own] * times).sum()))
        best.append(int((figures[1, own] * times).sum()))
    kept = docs.select(["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    return kept.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def align_tokenizers(docs: DataFrame, byte_bpe_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A is a byte-level BPE file (of ``tokenizers``) over a space and the text, B a sentencepiece model over the text, which
    adds that space; neither adds special tokens nor finds their strings in texts. Groups lie between bytes where tokens of
    both end; a link is an A and a B token occurrence whose bytes overlap. An id pair's count is how many rows hold it
    linked; ``n_best`` are the links whose count is the highest of their A id (ties all count), ``count_sum`` sums the
    counts over links. ``groups_sha256`` is of ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts of which a tokenizer doesn't keep all bytes (white space or characters it rewrites),
    have no tokens: zeros and an empty digest. Repeated rows and ids count as rows of their own; null ids stay; texts of
    any length are tokenized whole; other columns are ignored; an empty table gives no rows. The two vocabulary files, of
    fixed size, are broadcast. Pairs and figures of blocks are written to the shared folder while this is built.
    """
    only = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("__text"))
    kind = only.schema["id"].dataType.simpleString()
    files = Path(byte_bpe_path).read_text(), Path(pieces_path).read_bytes()
    shared = only.sparkSession.sparkContext.broadcast(files)
    size_b = sentencepiece.SentencePieceProcessor(model_proto=files[1]).get_piece_size()
    arrow = only.select("id").limit(0).toArrow().schema.field("id").type
    made = stored(only.mapInArrow(_align(shared, arrow), f"id {kind}, {MADE}"), "aligned")
    held = made.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "held"))
    held = held.select("block", "place", "held.pairs", "held.n_docs")
    counts = held.groupBy("pairs").agg(F.sum("n_docs").alias("n"))
    # An A id has a pair per B id at most: the size of a vocabulary bounds what one task orders.
    highest = F.max("n").over(Window.partitionBy(F.expr(f"pairs div {size_b}")))
    counts = counts.select("pairs", "n", (F.col("n") == highest).cast("int").alias("best"))
    figures = held.select("block", "place", "pairs").join(counts, "pairs").select(F.col("block").alias("of"), "place", "n", "best")
    rows = made.where("pairs IS NULL").select("id", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times")
    schema = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    scored = rows.groupBy("block").cogroup(figures.groupBy("of")).applyInArrow(_score, schema)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return scored.select(F.col("id").alias(id_col), *map(F.col, map(quoted, names)))
