"""Packing: pieces against the library, bins against bounds."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickbars.llm import packing, queries_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def known():
    return packing.ChunkIds(open(PATH).read())


def ids(known, text):
    raw = b"".join(map(known.__getitem__, text.encode().split()))
    return np.frombuffer(raw, np.uint32).tolist()


SAMPLES = ["", "Hello, World's x1 22 éÀÿßµªº 漢字!", "<|endoftext|>a <|startoftext|> b<|endoftext|>.", "é ́x", "don't. it's! 'S", "A B　c ", "İstanbul ΣΑΣ", "... !? ;", "x" * 500]


@pytest.mark.parametrize("text", SAMPLES)
def test_ids_like_the_library(known, library, text):
    assert ids(known, text) == library.encode(text, add_special_tokens=False).ids


def test_every_letter_of_the_direct_path(known, library):
    for c in map(chr, range(256)):
        for text in (f"{c}", f"a{c}b", f"{c}{c}.", f"Q{c}!?"):
            assert ids(known, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(known, library, text):
    assert ids(known, text) == library.encode(text, add_special_tokens=False).ids


def checked(rows, texts, library):
    """Rows of a packing: pieces are the library's, bins are gapless and small enough. Gives the number of bins."""
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for doc, own in pieces.items():
        whole = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1], np.uint32)
        own.sort(key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(whole), 4096)) and [r.piece for r in own] == list(range(len(own)))
        for r in own:
            part = whole[r.start : r.start + 4096]
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= 4096
    return len(bins)


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries_packing.op5_best_fit_pack(spark, sf_dir).collect()
    total = sum(r.length for r in rows)
    assert checked(rows, texts, library) <= -(-total // 4096) + 1


def test_edge_rows(spark, docs_of, library):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "one two")]
    frame = docs_of(rows).selectExpr("*", "1 AS length", "2 AS sequence_id", "3 AS __id")
    assert checked(packing.pack_documents(frame, PATH, 1).collect(), dict(rows), library) == 3
    again = docs_of([(1, "a b"), (1, "a b"), (None, "c")])
    assert sorted((r.doc_id or 0, r.length) for r in packing.pack_documents(again, PATH, 1).collect()) == [(0, 2), (1, 3), (1, 3)]
    assert packing.pack_documents(frame.limit(0), PATH, 1).count() == 0
    full = packing.pack_documents(frame, PATH, 1, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in full)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_bins(lengths):
    bins = packing.pack(lengths, 100)
    rows = sorted(r for b in bins for _, r in b.items)
    assert rows == list(range(len(lengths)))
    assert all(sum(n for n, _ in b.items) + b.free == 100 and b.free >= 0 and b.items for b in bins)
    assert len(bins) <= len(packing.best_fit([(n, i) for i, n in enumerate(lengths)], 100))


def test_swaps_beat_best_fit():
    """Best fit leaves waste that swaps remove."""
    better = 0
    for seed in range(60):
        rng = random.Random(seed)
        lengths = [rng.randrange(15, 60) for _ in range(60)]
        better += len(packing.pack(lengths, 100)) < len(packing.best_fit([(n, i) for i, n in enumerate(lengths)], 100))
    assert better >= 3


def test_two_for_one():
    source, target = packing.Bin(100), packing.Bin(100)
    for x in ((30, 0), (25, 1)):
        source.put(x)
    for x in ((50, 2), (45, 3)):
        target.put(x)
    gain, give, back = packing.best_change(source, target)
    assert gain == 5 and sum(n for n, _ in give) - sum(n for n, _ in back) == 5


def test_changes_raise_squared_fill():
    rng = random.Random(4)
    bins = packing.best_fit([(rng.randrange(20, 70), i) for i in range(80)], 100)
    before = sum((100 - b.free) ** 2 for b in bins)
    assert sum((100 - b.free) ** 2 for b in packing.improve(bins, 100)) >= before


@pytest.mark.parametrize(("low", "high", "most"), [(700, 2000, 1.035), (1100, 2000, 1.1), (400, 1800, 1.0)])
def test_mid_lengths_near_the_bound(low, high, most):
    """Some thousand pieces of a tenth to a half of a sequence: bins against the lower bound and best fit."""
    rng = random.Random(1)
    lengths = [rng.randint(low, high) for _ in range(3000)]
    bins = packing.pack(lengths, 4096)
    assert sorted(r for b in bins for _, r in b.items) == list(range(3000))
    assert len(bins) <= most * -(-sum(lengths) // 4096)
    assert len(bins) < len(packing.best_fit([(n, i) for i, n in enumerate(lengths)], 4096))


def test_no_bin_has_a_change_left():
    """Where bins could still be saved, no underfull bin has a change with any other that raises squared fill."""
    rng = random.Random(2)
    under = [b for b in packing.pack([rng.randint(1100, 2000) for _ in range(600)], 4096) if b.free]
    assert sum(b.free for b in under) >= 4096 and len(under) > 40
    for source in under:
        for target in under:
            if source is not target and (found := packing.best_change(source, target)):
                assert target.free - found[0] >= source.free
