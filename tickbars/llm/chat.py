"""Chat formatting by columnar byte assembly.

Template: every turn becomes ``### role: text</turn>\\n``. Inside roles and texts a backslash is put before each
backslash, each ``### `` and each ``</turn>`` (in roles also before each colon), so the marks that structure the output
are exactly the unescaped ones and reading back is exact.

A block of turns is assembled at once: segment lengths, their running offsets and the target index of every content byte
are numpy arrays, and headers and contents are copied into one preallocated Arrow buffer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import column_of, named
from tickbars.llm.spans import buffers

HEAD, MIDDLE, FOOT = b"### ", b": ", b"</turn>\n"
TEXT_MARKS = (b"\\", b"### ", b"</turn>")
ROLE_MARKS = (*TEXT_MARKS, b":")
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]+|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(\\|### |</turn>|:)")

#: Turns of one conversation that are sure to stay in one piece, and bytes after which a piece is closed.
PIECE_TURNS, PIECE_BYTES = 4096, 8_000_000

SCHEMA = (
    "conv_id {id}, chunk long, piece int, text string, n_turns long, loss_start array<long>, loss_end array<long>"
)


def escaped(data: np.ndarray, offsets: np.ndarray, marks: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The column with a backslash before every mark; marks don't reach over the border of two rows."""
    n = len(data)
    at = np.zeros(n, bool)
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    for mark in marks:
        last = max(n - len(mark) + 1, 0)
        hit = np.ones(last, bool)
        for k, byte in enumerate(mark):
            hit &= data[k : k + last] == byte
        places = np.flatnonzero(hit)
        at[places[places + len(mark) <= row_end[places]]] = True
    before = np.concatenate([[0], np.cumsum(at)])
    out = np.full(n + before[-1], ord("\\"), np.uint8)
    out[np.arange(n) + before[1:]] = data
    return out, offsets + before[offsets]


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, turn offsets, text starts, text ends) of the formatted turns of a block."""
    role, role_at = escaped(*buffers(roles), ROLE_MARKS)
    text, text_at = escaped(*buffers(texts), TEXT_MARKS)
    n = len(roles)
    lens = np.empty((n, 5), np.int64)
    lens[:, 0], lens[:, 2], lens[:, 4] = len(HEAD), len(MIDDLE), len(FOOT)
    lens[:, 1], lens[:, 3] = np.diff(role_at), np.diff(text_at)
    place = np.concatenate([[0], np.cumsum(lens.ravel())])
    starts = place[:-1].reshape(n, 5)
    buffer = pa.allocate_buffer(int(place[-1]))
    out = np.frombuffer(buffer, np.uint8)
    for k, mark in ((0, HEAD), (2, MIDDLE), (4, FOOT)):
        out[starts[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    for k, data, at in ((1, role, role_at), (3, text, text_at)):
        out[np.arange(len(data)) + np.repeat(starts[:, k] - at[:-1], lens[:, k])] = data
    return buffer, np.append(starts[:, 0], place[-1]), starts[:, 3], starts[:, 4]


def _pieces(table: pa.Table, numbers: list[int], learnt: str) -> pa.RecordBatch:
    """One row for each piece; ``numbers`` holds the first turn of every piece and the number of turns."""
    roles = column_of(table, "role").combine_chunks()
    texts = column_of(table, "text").combine_chunks()
    buffer, turn_at, text_from, text_to = assembled(roles, texts)
    first = np.array(numbers[:-1], np.int64)
    cuts = turn_at[np.array(numbers, np.int64)]
    out = np.frombuffer(buffer, np.uint8)
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    loss = np.flatnonzero(np.asarray(pa.compute.equal(roles, learnt)))
    owner = np.searchsorted(first, loss, "right") - 1
    base = points[cuts[owner]]
    spans = [points[x[loss]] - base for x in (text_from, text_to)]
    bounds = pa.array(np.searchsorted(owner, np.arange(len(first) + 1)), pa.int32())
    text = pa.StringArray.from_buffers(len(first), pa.py_buffer(cuts.astype(np.int32)), buffer)
    taken = table.select(["conv_id", "chunk", "piece"]).take(pa.array(first)).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [
            *(x.combine_chunks() for x in taken.columns),
            text,
            pa.array(np.diff(np.array(numbers, np.int64))),
            *(pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int64))) for x in spans),
        ],
        names=["conv_id", "chunk", "piece", "text", "n_turns", "loss_start", "loss_end"],
    )


def _format(learnt: str, piece_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (conv_id, chunk, piece, role, text) of pieces that may still grow
        size = number = taken = 0
        key: object = None
        types: list = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            cuts = [i for i, x in enumerate(held) if not i or x[:3] != held[i - 1][:3]]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            table = pa.table(arrays, names=["conv_id", "chunk", "piece", "role", "text"])
            return _pieces(table, [*cuts, len(held)], learnt)

        for batch in batches:
            columns = [column_of(batch, c) for c in ("conv_id", "chunk", "role", "text")]
            types = [columns[0].type, pa.int64(), pa.int32(), pa.string(), pa.string()]
            for conv, chunk, role, text in zip(*(c.to_pylist() for c in columns), strict=True):
                role, text = role or "", text or ""
                if held and (conv, chunk) != key:
                    number = taken = 0
                    if size > piece_bytes:
                        yield flush()
                        held, size = [], 0
                elif held and taken > piece_bytes:
                    yield flush()
                    held, size, taken = [], 0, 0
                    number += 1
                key = (conv, chunk)
                held.append((conv, chunk, number, role, text))
                n = len(role) + len(text) + 32
                size, taken = size + n, taken + n
        if held:
            yield flush()

    return run


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learnt_role: str = "assistant",
    piece_turns: int = PIECE_TURNS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Formatted conversations: ``conv_id, chunk, piece, text, n_turns, loss_start, loss_end``.

    A conversation is one row, unless its turn numbers pass a multiple of ``piece_turns`` or its text passes
    ``piece_bytes``: then it is several rows whose texts, in order of ``chunk`` and ``piece``, make up the whole. So a
    conversation that holds a third of all rows is dealt out over many tasks. ``loss_start``/``loss_end`` are code-point
    places within the row's text of what a model should learn (texts of ``learnt_role``, still escaped).

    Turns are ordered by turn, role, text, nulls first. A null role or text counts as empty; null conversation ids form
    one conversation with a null id; repeated rows are repeated turns; an empty table gives no rows; other columns are
    ignored.
    """
    picked = turns.select(
        named(conv_col).alias("conv_id"),
        F.coalesce(F.floor(named(turn_col) / F.lit(piece_turns)).cast("long"), F.lit(-(2**62))).alias("chunk"),
        named(turn_col).alias("turn"),
        named(role_col).cast("string").alias("role"),
        named(text_col).cast("string").alias("text"),
    )
    dealt = picked.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "turn", "role", "text")
    schema = SCHEMA.format(id=picked.schema["conv_id"].dataType.simpleString())
    return dealt.select("conv_id", "chunk", "role", "text").mapInArrow(_format(learnt_role, piece_bytes), schema)


def read_turns(text: str) -> Iterator[tuple[str, str, int]]:
    """(role, text, place of the escaped text in code points) of every turn of a formatted text."""
    at = 0
    while at < len(text):
        turn = TURN.match(text, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        yield unescaped(turn[1]), unescaped(turn[2]), turn.start(2)
        at = turn.end()
