"""Cross-tokenizer alignment beside a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tickbars.llm import alignment
from tickbars.llm.queries_alignment import A, B, op12_tokenizer_alignment
from tickbars.llm.tokens import byte_letters


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(public_tokenizers.path(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))


def plain(rows, coders):
    """The figures of (id, text) rows, token pair by token pair."""
    a, b = coders
    back = {letter: x for x, letter in enumerate(byte_letters())}
    per_doc, held = [], Counter()
    for doc, text in rows:
        said = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        spelt_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        spelt_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            spelt_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(spelt_a) != said or b"".join(spelt_b) != said:
            per_doc.append((doc, 0, 0, 0, [], ""))
            continue
        spans = []
        for spelt in (spelt_a, spelt_b):
            at, own = 0, []
            for s in spelt:
                own.append((at, at + len(s)))
                at += len(s)
            spans.append(own)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, (s, e) in zip(ids, own, strict=True) if start <= s and e <= end) for ids, own in zip((ids_a, ids_b), spans, strict=True)]
            groups.append("|".join(sides))
            start = end
        links, j = [], 0
        for i, (s, e) in zip(ids_a, spans[0], strict=True):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(ids_b) and spans[1][k][0] < e:
                links.append((i, ids_b[k]))
                k += 1
        held.update(set(links))
        per_doc.append((doc, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    out = []
    for doc, n_a, n_b, n_groups, links, digest in per_doc:
        best = sum(held[x] == top[x[0]] for x in links)
        out.append((doc, n_a, n_b, n_groups, len(links), best, sum(held[x] for x in links), digest))
    return sorted(out, key=repr)


EDGES = [
    None,
    "",
    " ",
    "  two  spaces ",
    "tabs\tand\nlines\r\n",
    "<|endoftext|> <s></s> <unk> <0x41>",
    "a▁b",
    "á ﬁ Ａ 　   x",
    "naïve Ärger 漢字 ひらがな 한글 😀👍🏽 \U00010348",
    "\x00\x01\x7f",
    "don't we'll I'D 1234567 1,000.50 -- ...",
    "same same",
    "same same",
    "antidisestablishmentarianism floccinaucinihilipilification " * 3,
]


def run(docs, **names):
    found = alignment.align_tokenizers(docs, public_tokenizers.path(A), public_tokenizers.path(B), **names)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_edges(docs_of, coders):
    rows = list(enumerate(EDGES)) + [(None, "same text"), (3, "same text"), (3, "same text")]
    assert run(docs_of(rows)) == plain(rows, coders)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


def test_clashing_names(spark, coders):
    names = ["block", "n_a", "pairs", "id", "te.xt"]
    docs = spark.createDataFrame([(1, "x", 2.0, "k1", "alpha beta"), (1, None, None, None, "alpha")], "block int, n_a string, pairs double, id string, `te.xt` string")
    assert docs.columns == names
    assert run(docs, id_col="id", text_col="te.xt") == plain([("k1", "alpha beta"), (None, "alpha")], coders)


def test_long_text(docs_of, coders, monkeypatch):
    monkeypatch.setattr(alignment, "WINDOW", 1000)
    rng = random.Random(4)
    text = " ".join(rng.choice(["reorganise", "the", "Überfluss", "x1", "\n"]) for _ in range(30_000))
    rows = [(0, text), (1, text[:5000])]
    assert run(docs_of(rows)) == plain(rows, coders)


def test_query(spark, sf_dir, coders):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = op12_tokenizer_alignment(spark, sf_dir)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows, coders)


def test_fast_ids_are_the_librarys():
    coder = alignment.ByteLevel(open(public_tokenizers.path(A)).read())
    assert coder.fast is not None
    letters = [chr(c) for c in range(0x3100) if not alignment.OUTSIDE.search(chr(c))]
    rng = random.Random(1)
    texts = [f"a{c}b {c} {c}{c}1 {c}'s\n{c}" for c in letters]
    words = [b.decode() for b in coder.bytes.values() if not b.decode(errors="ignore").encode() != b]
    texts += ["".join(rng.choices(words, k=rng.randint(2, 6))) for _ in range(30_000)]
    texts = [t for t in texts if not alignment.OUTSIDE.search(t)]
    want = [e.ids for e in coder.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode(texts)] == want


def test_packed():
    rng = np.random.default_rng(2)
    values = rng.integers(1, 1 << rng.integers(1, 40, 2000))
    assert (alignment.unpacked(np.frombuffer(alignment.packed(values), np.uint8)) == values).all()
    assert len(alignment.unpacked(np.zeros(0, np.uint8))) == 0
