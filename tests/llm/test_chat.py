"""Chat formatting: exact round trip, loss mask, hot conversations, edge rows."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa

from tickbars.llm import chat, queries_chat
from tickbars.llm.spans import buffers

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
TRICKY = st.lists(st.sampled_from(["\\", "### ", "</turn>", "#", "<", ":", "a", "é", "\n", " ", "</turn", "𝄞"]), max_size=12).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(TRICKY, TRICKY), min_size=1, max_size=8))
def test_round_trip(turns):
    buffer, at, text_from, text_to = chat.assembled(pa.array([r for r, _ in turns], pa.string()), pa.array([t for _, t in turns], pa.string()))
    raw = buffer.to_pybytes()
    assert [(r, t) for r, t, _ in chat.read_turns(raw.decode())] == turns
    for i, (_, text) in enumerate(turns):
        assert chat.unescaped(raw[text_from[i] : text_to[i]].decode()) == text
        assert raw[at[i] : at[i + 1]].decode().endswith("</turn>\n")


def test_escape_does_not_cross_rows():
    data, at = chat.escaped(*buffers(pa.array(["##", "# ", ""])), chat.TEXT_MARKS)
    assert bytes(data) == b"### " and list(at) == [0, 2, 4, 4]


def plain(rows):
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        mark = lambda s: s.replace("\\", "\\\\").replace("### ", "\\### ").replace("</turn>", "\\</turn>")
        whole = "".join(f"### {mark(r).replace(':', chr(92) + ':')}: {mark(t)}</turn>\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole))
    return out


EDGE = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "é ### </turn> \\"), (1, 1, "assistant", "é ### </turn> \\"), (1, None, None, None),
    (2, 5, "assistant", ""), (2, 5, "tool:x", "b"), (None, 1, "user", "lost"), (None, 0, "assistant", "x" * 5000), (3, 0, "user", None),
]


def test_query_against_plain(spark, table_dir):
    frame = spark.createDataFrame(EDGE, TURNS).selectExpr("*", "1 AS chunk", "2 AS piece")
    got = {r[0]: tuple(r[1:]) for r in queries_chat.op1_chat_format(spark, table_dir(conversations=frame)).collect()}
    assert got == plain([*EDGE, (-7, 0, "user", queries_chat.SAMPLE), (-7, 1, "assistant", queries_chat.SAMPLE)])


def test_long_conversation_in_pieces(spark):
    rows = [(9, i, "assistant" if i % 2 else "user", f"### {i}" * (i % 7)) for i in range(500)]
    pieces = chat.format_chats(spark.createDataFrame(rows, TURNS), piece_turns=64, piece_bytes=300)
    found = sorted(pieces.collect(), key=lambda r: (r.chunk, r.piece))
    assert len(found) > 8 and len({(r.chunk, r.piece) for r in found}) == len(found)
    text = "".join(r.text for r in found)
    assert [(r, t) for r, t, _ in chat.read_turns(text)] == [(r, t) for _, _, r, t in rows]
    learnt = [chat.unescaped(r.text[a:b]) for r in found for a, b in zip(r.loss_start, r.loss_end)]
    assert learnt == [t for _, _, r, t in rows if r == "assistant"]


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_broken_text():
    with pytest.raises(ValueError):
        list(chat.read_turns("### user hi"))


def test_offsets_of_sliced_column():
    data, at = buffers(pa.array(["ab", "cd", "ef"]).slice(1))
    assert bytes(data) == b"cdef" and list(at) == [0, 2, 4] and at.dtype == np.int64
