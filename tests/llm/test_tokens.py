"""Token counts against the library."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickbars.llm import queries_tokens, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    vocabulary = tokens.Vocabulary(open(PATH).read())
    return tokens.Counter(vocabulary, vocabulary.prove())


TEXTS = ["", " ", "a", "Hello  world's\n\n x1 22 é ß漢字 !!", "<|endoftext|>a <|endoftext|><|endoftext|>", "x" * 3000, "\x00\x1c\x85\u2028 \u3000b", "𐵀 \u058b 𞤀", "a\r\n\t b'll 'S"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_like_the_library(counter, library, text):
    assert sum(counter.count(text)) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(counter, library, text):
    assert sum(counter.count(text)) == len(library.encode(text, add_special_tokens=False).ids)


def test_blocks_where_the_pattern_is_used(library):
    """Over every character of these blocks the pattern splits as the library does."""
    splitter = library.pre_tokenizer
    for code in range(0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or tokens.OUTSIDE.search(c):
            continue
        text = f"a{c}b{c}1{c}{c} {c}  {c}!{c}"
        pattern = tokens.ASCII_PATTERN if code < 128 else tokens.PATTERN
        assert pattern.findall(text) == [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)], hex(code)


def test_proof(counter, library):
    assert len(counter.whole) > 40_000
    for piece in list(counter.whole)[::997]:
        assert counter.vocabulary.merged(piece) == 1


def test_query(spark, sf_dir, library):
    got = {r.doc_id: r for r in queries_tokens.op2_token_count(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert (got[row.doc_id].n_tokens, got[row.doc_id].n_bytes, got[row.doc_id].over_limit) == (n, len((row.text or "").encode()), n > 512)


def test_edge_rows(spark, docs_of):
    frame = docs_of([(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b")]).selectExpr("*", "1 AS n_tokens", "2 AS n_bytes")
    got = sorted(tokens.count_tokens(frame, PATH).collect(), key=str)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == [(0, 3, 2), (1, 0, 0), (1, 0, 0), (2, 3, 2), (2, 3, 2)]
    assert tokens.count_tokens(frame.limit(0), PATH).count() == 0
