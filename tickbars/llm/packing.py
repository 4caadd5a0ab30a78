"""Best-fit packing of token sequences, improved by swaps.

Texts become token ids; long ones are cut into full pieces. Pieces are packed where they are read: a task packs a block
of pieces at a time by best fit, longest first, then searches locally. Between bins that are not full it moves one piece
or two, or exchanges one for one or two for one, whenever that raises the sum of squared fills; fuller bins get full and
emptier ones empty. Every such bin is a source in turn, any other its target (an index by room finds the best), until a
whole round changes nothing or no bin can be saved. What is still underfull joins the next block, and what a task has left at its end (a bounded number of
pieces) is packed once more in groups over all tasks. Only those few light rows are shuffled.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickbars.llm.shared import blocks, column_of, named, stored, texts_of
from tickbars.llm.tokens import byte_letters

CAPACITY = 4096
#: Pieces (and tokens) packed together, pieces carried on from block to block, and pieces of a group at the end.
BLOCK_PIECES, BLOCK_TOKENS, CARRIED, GROUP_PIECES = 20_000, 16_000_000, 2_000, 20_000

#: Chunks of text whose ids a worker remembers; beyond it the older half is dropped.
REMEMBERED = 500_000

ENDINGS = b".,;:!?"

#: A byte that no UTF-8 text has, for the end of a word; and bytes of a word that are merged as ranks at most.
END, LONG_WORD = b"\xff", 1_000


class ChunkIds(dict):
    """Ids, as bytes, of chunks between white space; the tokenizer drops white space and never merges across it.

    A chunk of letters up to U+00FF is one pre-token whose normal form is its lower case, so the model is asked directly;
    every other chunk goes through the whole library.
    """

    def __init__(self, source: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(source)
        self.model = self.tokenizer.model
        self.old: dict[bytes, bytes] = {}
        self.table = str.maketrans({chr(b): letter for b, letter in enumerate(byte_letters())})
        self.ranks = self._ranked(json.loads(source)["model"])

    @staticmethod
    def _ranked(model: dict) -> tiktoken.Encoding | None:
        """The merges as ranks of byte strings, where every merge makes the next id. The end-of-word suffix is a byte that
        UTF-8 doesn't have; it joins the last byte before anything else, as the suffix is on the last letter from the start."""
        suffix, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
        back = {letter: bytes([b]) for b, letter in enumerate(byte_letters())}

        def spelt(entry: str) -> bytes:
            end = END if entry.endswith(suffix) else b""
            return b"".join(back[c] for c in entry.removesuffix(suffix)) + end

        merges = [m.split() if isinstance(m, str) else m for m in model["merges"]]
        if not suffix or [vocabulary["".join(m)] for m in merges] != list(range(512, 512 + len(merges))):
            return None
        ranks = {spelt(entry): i for entry, i in vocabulary.items() if i < 512 + len(merges)}
        singles = {b + e for b in back.values() for e in (b"", END)}
        if len(ranks) != 512 + len(merges) or {b for b, i in ranks.items() if i < 512} != singles:
            return None
        return tiktoken.Encoding("ranks", pat_str="", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.encoded(chunk)
        if len(chunk) <= 64:
            if 2 * len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def encoded(self, chunk: bytes) -> bytes:
        core = chunk.rstrip(ENDINGS)
        if core and core != chunk:
            text = core.decode()
            if text.isalpha() and max(text) <= "ÿ":
                return self[core] + self[chunk[len(core) :]]
        text = chunk.decode()
        if text.isalpha() and max(text) <= "ÿ":
            said = text.lower().encode()
            if self.ranks is not None and len(said) < LONG_WORD:
                return array("I", self.ranks._encode_single_piece(said + END)).tobytes()
            found = [t.id for t in self.model.tokenize(said.decode("latin-1").translate(self.table))]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in found)


_KNOWN: dict[str, ChunkIds] = {}


def _known(source: str) -> ChunkIds:
    """One per Python worker, which serves many tasks."""
    if source not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[source] = ChunkIds(source)
    return _KNOWN[source]


def _tokenize(shared, end_id: int, capacity: int, with_ids: bool):
    names = ["__id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(shared.value)
        end, cut = end_id.to_bytes(4, "little"), 4 * capacity
        for block in blocks(batches):
            owner, rows, ids = [], [], []
            for i, text in enumerate(texts_of(block).cast(pa.binary()).to_pylist()):
                whole = b"".join(map(known.__getitem__, text.split())) + end
                for k, at in enumerate(range(0, len(whole), cut)):
                    part = whole[at : at + cut]
                    owner.append(i)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        ids.append(part)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            kept = column_of(block, "__id").take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([kept, *columns, *([pa.array(ids, pa.binary())] * with_ids)], names=names)

    return run


@dataclass
class Bin:
    free: int
    items: list[tuple[int, int]] = field(default_factory=list)  # (length, row)

    def put(self, item: tuple[int, int]) -> None:
        self.items.append(item)
        self.free -= item[0]

    def take(self, item: tuple[int, int]) -> None:
        self.items.remove(item)
        self.free += item[0]


def best_fit(pieces: list[tuple[int, int]], capacity: int) -> list[Bin]:
    """(length, row) pieces, longest first, each into the fullest bin that has room."""
    bins: list[Bin] = []
    by_free: dict[int, list[Bin]] = defaultdict(list)
    rooms = 0  # bit f: a bin with f tokens free exists
    for item in sorted(pieces, key=lambda x: (-x[0], x[1])):
        fitting = rooms >> item[0]
        if fitting:
            free = item[0] + (fitting & -fitting).bit_length() - 1
            found = by_free[free].pop()
            if not by_free[free]:
                rooms &= ~(1 << free)
        else:
            found = Bin(capacity)
            bins.append(found)
        found.put(item)
        if found.free:
            by_free[found.free].append(found)
            rooms |= 1 << found.free
    return bins


def best_change(source: Bin, target: Bin) -> tuple[int, list, list] | None:
    """The change that fills ``target`` most: (gain, items to give it, items it gives back)."""
    own = sorted(source.items)
    sizes = [n for n, _ in own]
    best: tuple[int, list, list] | None = None

    def largest(limit: int, below: int) -> int:
        return min(bisect_right(sizes, limit), below) - 1

    for back in [None, *{n: (n, r) for n, r in target.items}.values()]:
        given = back[0] if back else 0
        room = target.free + given
        k = largest(room, len(own))
        if k >= 0 and sizes[k] > given and (best is None or sizes[k] - given > best[0]):
            best = (sizes[k] - given, [own[k]], [back] if back else [])
        if best and best[0] == target.free:
            return best
        last = None
        for i in range(len(own) - 1, 0, -1):
            if sizes[i] == last or sizes[i] >= room:
                continue
            last = sizes[i]
            j = largest(room - sizes[i], i)
            if j >= 0 and sizes[i] + sizes[j] > given and (best is None or sizes[i] + sizes[j] - given > best[0]):
                best = (sizes[i] + sizes[j] - given, [own[i], own[j]], [back] if back else [])
        if best and best[0] == target.free:
            return best
    return best


class Rooms:
    """The places of underfull bins by room: a bin's free room, alone or with one of its pieces given back.

    ``least`` has for each room the shortest piece to give back, as ``piece * base + room``.
    """

    def __init__(self, bins: list[Bin], capacity: int):
        self.capacity, self.base = capacity, 2 * capacity + 2
        self.none = self.base * self.base
        self.least = np.full(self.base, self.none, np.int64)
        self.places: dict[int, dict[int, dict[int, Bin]]] = defaultdict(dict)
        for b in bins:
            self.add(b)

    def add(self, b: Bin) -> None:
        for n in {0, *(n for n, _ in b.items)}:
            room = b.free + n
            self.places[room].setdefault(n, {})[id(b)] = b
            self.least[room] = min(self.least[room], n * self.base + room)

    def drop(self, b: Bin) -> None:
        for n in {0, *(n for n, _ in b.items)}:
            room = b.free + n
            held = self.places[room]
            del held[n][id(b)]
            if not held[n]:
                del held[n]
                self.least[room] = min(held) * self.base + room if held else self.none

    def target(self, source: Bin) -> Bin | None:
        """The bin that gains most from one or two pieces of ``source``, one that gets full before any other; the source
        itself must not be among the places.

        Giving ``c`` into a place with room ``r`` raises the squared fills if ``c <= r < c + source.free``.
        """
        many = Counter(n for n, _ in source.items)
        kinds = list(many)
        sums = {*kinds, *(2 * n for n in kinds if many[n] > 1), *(a + b for i, a in enumerate(kinds) for b in kinds[:i])}
        given = np.array(sorted(c for c in sums if c <= self.capacity), np.int64)
        exact = self.least[given]
        gains = given - exact // self.base
        best = int(gains.argmax())
        if gains[best] <= 0:
            span, lowest = 1, self.least
            while 2 * span <= source.free:
                lowest = np.minimum(lowest[:-span], lowest[span:])
                span *= 2
            exact = np.minimum(lowest[given], lowest[given + source.free - span])
            gains = given - exact // self.base
            best = int(gains.argmax())
            if gains[best] <= 0:
                return None
        piece, room = divmod(int(exact[best]), self.base)
        return next(iter(self.places[room][piece].values()))


def improve(bins: list[Bin], capacity: int) -> list[Bin]:
    """Local search between underfull bins; squared fill only rises, and empty bins go."""
    full = [b for b in bins if not b.free]
    under = [b for b in bins if b.free]
    spare = sum(b.free for b in under)  # under one bin: as few bins as there can be
    rooms = Rooms(under if spare >= capacity else [], capacity)
    changed = True
    while changed and spare >= capacity:
        changed = False
        for source in sorted(under, key=lambda b: -b.free):
            if spare < capacity:
                break
            if not source.free:
                continue
            rooms.drop(source)
            while source.items and (target := rooms.target(source)):
                _, give, back = best_change(source, target)
                rooms.drop(target)
                for item in give:
                    source.take(item)
                    target.put(item)
                for item in back:
                    target.take(item)
                    source.put(item)
                if target.free:
                    rooms.add(target)
                changed = True
            if source.items:
                rooms.add(source)
            else:
                spare -= capacity
        full += [b for b in under if not b.free]
        under = [b for b in under if b.free and b.items]
    return full + under


def pack(lengths: list[int], capacity: int) -> list[Bin]:
    return improve(best_fit([(n, i) for i, n in enumerate(lengths)], capacity), capacity)


def _placed(table: pa.Table, bins: list[Bin], first: int | None) -> pa.Table:
    """The rows of the bins with sequence number and offset; without a first number the rows stay open."""
    rows, sequence, offset = [], [], []
    for k, b in enumerate(bins):
        at = 0
        for n, row in sorted(b.items, key=lambda x: x[1]):
            rows.append(row)
            sequence.append(None if first is None else first + 2 * k)
            offset.append(None if first is None else at)
            at += n
    out = table.take(pa.array(rows, pa.int64()))
    return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))


def _pack_tasks(capacity: int):
    """Packs the pieces of a task block by block; closed bins get even numbers, the last underfull ones stay open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.Table] = []
        pieces = tokens = 0

        def settle(last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
            nonlocal number
            table = pa.concat_tables(held).combine_chunks()
            bins = pack(table.column("length").to_pylist(), capacity)
            bins.sort(key=lambda b: -b.free)
            open_, n = [], 0
            for b in bins:
                n += len(b.items)
                if not b.free or n > CARRIED:
                    break
                open_.append(b)
            closed = bins[len(open_) :]
            out = _placed(table, closed, number).to_batches() if closed else []
            number += 2 * len(closed)
            rest = table.take(pa.array([row for b in open_ for _, row in b.items], pa.int64()))
            if last and open_:
                out += _placed(table, open_, None).to_batches()
            return out, rest

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = pa.Table.from_batches([batch.slice(at, 2000)])
                held.append(part)
                pieces += part.num_rows
                tokens += pa.compute.sum(part.column("length")).as_py() or 0
                if pieces >= BLOCK_PIECES or tokens >= BLOCK_TOKENS:
                    out, rest = settle(False)
                    yield from out
                    held, pieces, tokens = [rest], rest.num_rows, pa.compute.sum(rest.column("length")).as_py() or 0
        if pieces:
            yield from settle(True)[0]

    return run


def _pack_group(capacity: int, names: list[str]):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.select(names).combine_chunks()
        return _placed(rows, pack(rows.column("length").to_pylist(), capacity), (key[0].as_py() << 32) + 1)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset``, and the ``ids`` themselves if asked for.

    A row's ids are those of its text by the tokenizer (whose pre-tokens must not reach across white space), then
    ``end_id``; only rows of more than ``capacity`` ids are cut, into full pieces and a rest. The pieces of one
    ``sequence_id`` lie one after the other from offset 0 and take up ``capacity`` ids at most.

    Null and empty texts are the end id alone; repeated rows are packed each; null ids stay; ties go by place in the
    input; texts of any length are packed whole, piece by piece; other columns are ignored; an empty table gives no rows. The packed pieces of the tasks are written to the
    shared folder once, so no text is tokenized twice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())
    picked = docs.select(named(id_col).alias("__id"), named(text_col).cast("string").alias("__text"))
    kind = picked.schema["__id"].dataType.simpleString()
    schema = f"__id {kind}, piece int, start long, length long, ids_crc32 long{', ids binary' * with_ids}, sequence_id long, offset long"
    names = ["__id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    tokenized, pack_pieces = _tokenize(shared, end_id, capacity, with_ids), _pack_tasks(capacity)
    # One function, so that a task keeps one Python worker busy and not two.
    packed = stored(picked.mapInArrow(lambda batches: pack_pieces(tokenized(batches)), schema), "packed")
    rest = packed.where("sequence_id IS NULL").drop("sequence_id", "offset")
    groups = -(-rest.count() // GROUP_PIECES) or 1
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    settled = rest.withColumn("__group", group).groupBy("__group").applyInArrow(_pack_group(capacity, names), schema)
    both = packed.where("sequence_id IS NOT NULL").unionByName(settled)
    return both.withColumnRenamed("__id", id_col)
