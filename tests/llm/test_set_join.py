"""N-gram Jaccard join beside brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tickbars.llm import set_join
from tickbars.llm.queries_set_join import op13_ngram_jaccard_join

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, size=3):
    words = [w.lower() for w in WORD.findall((text or "").encode())]
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(rows, percent=90, size=3):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = {}
    for i, own in enumerate(sets):
        seen = {}
        for s in own:
            for j in holders.get(s, ()):
                seen[j] = seen.get(j, 0) + 1
            holders.setdefault(s, []).append(i)
        for j, both in seen.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((doc, len(s), least.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def run(docs, **given):
    return sorted((tuple(r) for r in set_join.join_similar(docs, **given).collect()), key=repr)


def family(rng, size, n, edits, vocabulary="abcdefghijklmnopqrstuvwxyz"):
    """Texts made from one text, each with some words changed."""
    words = [rng.choice(vocabulary) + rng.choice(vocabulary) + str(rng.randrange(30)) for _ in range(n)]
    out = []
    for _ in range(size):
        own = list(words)
        for _ in range(rng.randrange(edits + 1)):
            k = rng.randrange(len(own))
            if rng.random() < 0.5:
                own[k] = rng.choice(["the", "a", "x" + str(rng.randrange(50))])
            else:
                del own[k]
        out.append(" ".join(own))
    return out


EDGES = [None, "", " \n\t", "one", "One two", "one two", "a b c", "A B  c", "a b c d e f g h i j k", "a b c d e f g h i j k l"]


def test_edges(docs_of):
    rows = list(enumerate(EDGES)) + [(None, "a b c"), (None, "only null here " * 3), (4, "one two"), (4, "quite other words")]
    assert run(docs_of(rows)) == plain(rows)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "n", b"r", "k1", "alpha beta"), (1, None, None, "k0", "Alpha beta")], "n int, node string, root binary, token string, `te.xt` string")
    assert run(docs, id_col="token", text_col="te.xt") == [("k0", 1, "k0"), ("k1", 1, "k0")]


def test_long_text(docs_of):
    rng = random.Random(9)
    words = [str(rng.randrange(10**6)) for _ in range(120_000)]
    near = list(words)
    near[5000:5400] = ["changed"]
    far = list(words)
    for k in range(0, len(far), 40):
        far[k] = "other"
    rows = [(5, " ".join(words)), (3, " ".join(near)), (1, " ".join(far))]
    assert run(docs_of(rows)) == plain(rows)


def test_families(docs_of, seed=1):
    """Short and long lists, chains of near copies, leaders that not everyone is linked with."""
    rng = random.Random(seed)
    texts = []
    for size, n, edits in [(40, 60, 8), (50, 120, 14), (5, 400, 40), (3, 11, 1)]:
        texts += family(rng, size, n, edits)
    texts += [" ".join(rng.choices(["to", "be", "or", "not"], k=rng.randrange(3, 14))) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    for plan in (set_join.Plan(), set_join.Plan(short=4, few=8, counters=64)):
        assert run(docs_of(rows), plan=plan) == plain(rows)


def test_chain(docs_of):
    """Each text is linked with the next one only."""
    words = [f"w{i}" for i in range(400)]
    rows = [(99 - k, " ".join(words[3 * k : 3 * k + 80])) for k in range(25)]
    assert len({c for *_, c in plain(rows)}) == 1
    assert run(docs_of(rows), plan=set_join.Plan(short=2, few=2)) == plain(rows)


def test_block_pairs():
    rng = np.random.default_rng(3)
    plan = set_join.Plan()
    sizes = rng.integers(2, 12, 50)
    starts = np.append(0, np.cumsum(sizes))
    n, place = rng.integers(40, 60, starts[-1]), rng.integers(0, 4, starts[-1])
    got = {frozenset(x) for x in zip(*(v.tolist() for v in set_join.block_pairs(starts, n, place, plan)), strict=True)}
    want = set()
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        for i in range(a, b):
            for j in range(a, i):
                if min(n[i] - place[i], n[j] - place[j]) * 190 >= 90 * (n[i] + n[j]):
                    want.add(frozenset((i, j)))
    assert got == want


def test_bitmaps_never_rule_out_too_much():
    """Bits differ in no more places than shingles do, sets of different sizes and folded bitmaps included."""
    rng = np.random.default_rng(5)
    for n in (3, 40, 200, 300, 900, 1100):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.append(x[rng.integers(0, 9, len(x)) > 0], rng.integers(0, 2**63, n // 4).astype(np.uint64)))
        a, b = set_join.parities(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        apart = len(np.setxor1d(x, y))
        assert apart / 8 <= set_join.differing_bits(a, b) <= apart and set_join.differing_bits(a, a) == 0


def test_shared_by_leader():
    lead, x, z = ({1, 2, 3, 4, 5}, {1, 2, 3, 8, 9}, {2, 3, 4, 8, 7})
    arrays = [np.array(sorted(s)) for s in (lead - x, x - lead, lead - z, z - lead)]
    assert set_join.shared_by_leader(len(lead), *arrays) == len(x & z)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op13_ngram_jaccard_join(spark, sf_dir).collect()), key=repr) == plain(rows)


def test_only_compared_texts_move(spark, docs_of, monkeypatch):
    """Texts of classes without a candidate aren't looked up, however often pairs are compared."""
    moved = []

    def watched(only, wanted, find=set_join.texts_by_id):
        moved.append(wanted.count())
        return find(only, wanted)

    monkeypatch.setattr(set_join, "texts_by_id", watched)
    own = [" ".join(f"w{i}_{k}" for k in range(30)) for i in range(60)]
    near = [t + " end" for t in own[:3]]
    rows = list(enumerate(own + near))
    got = {r.doc_id: r.component_id for r in set_join.join_similar(docs_of(rows)).collect()}
    assert got == {i: i - 60 if i >= 60 else i for i in range(63)}
    assert moved == [6]
