"""Near duplicates against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tickbars.llm import components, neardup, queries_neardup
from tickbars.llm.spans import buffers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def plain(rows):
    """(id, text) rows to sorted (id, size, component, kept)."""
    sets = sorted({shingles(t) for _, t in rows if shingles(t)}, key=sorted)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    at = {s: root(i) for i, s in enumerate(sets)}
    least = {}
    for i, t in rows:
        s = shingles(t)
        if s and i is not None:
            least[at[s]] = min(i, least.get(at[s], i))
    out = []
    for i, t in rows:
        s = shingles(t)
        c = least.get(at[s]) if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=str)


def answer(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def variants(seed, base_words, copies, most):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(base_words)]
    out = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(most)):
            k = rng.randrange(len(words))
            words[k : k + rng.randrange(1, 3)] = [f"x{rng.randrange(10**6)}"] * rng.randrange(0, 3)
        out.append(" ".join(words))
    return out


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert answer(queries_neardup.op4_minhash_near_dedup(spark, sf_dir)) == plain(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_crowded_groups(spark, docs_of, seed):
    """A large group around one text, with outliers on either side of the limit, through every path."""
    texts = variants(seed, 120, 150, 9) + variants(seed + 10, 60, 25, 6) + variants(seed + 20, 300, 10, 30) + ["", None, "A b", "a B", " a  b "]
    random.Random(seed).shuffle(texts)
    rows = list(enumerate(texts))
    for small in (3, 8):
        got = answer(neardup.find_near_duplicates(docs_of(rows), plan=neardup.Plan(small=small, few=small)))
        assert got == plain(rows)


def test_chain(spark, docs_of):
    """Each version is linked with the next only; the component reaches the first."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(40):
        rows.append((100 + i, " ".join(words)))
        words[2 * i : 2 * i + 2] = [f"n{rng.random()}", f"m{i}"]
    got = answer(neardup.find_near_duplicates(docs_of(rows), plan=neardup.Plan(small=2, few=2)))
    assert got == plain(rows) and {r[2] for r in got} == {100}


def test_edge_rows(spark, docs_of):
    same = "one two three four five six seven"
    rows = [(5, same), (5, same), (5, "other words " * 9), (None, same), (None, "lone text"), (9, same.upper()), (7, None), (8, ""), (8, "\t\n")]
    frame = docs_of(rows).selectExpr("*", "1 AS n_shingles", "2 AS node", "3 AS kept")
    got = answer(neardup.find_near_duplicates(frame))
    assert [(r[0], r[1], r[2]) for r in got] == [(r[0], r[1], r[2]) for r in plain(rows)]
    assert {r[0]: r[3] for r in got if r[0] in (7, 8, 9)} == {7: True, 8: True, 9: False}
    assert neardup.find_near_duplicates(frame.limit(0)).count() == 0


def test_sketch_estimates():
    """Odd sketches tell 0.8 from 0.9 and stay within the slack."""
    plan = neardup.Plan()
    rng = np.random.default_rng(3)
    for share in (0.6, 0.8, 0.85, 0.9, 0.97):
        both = rng.integers(0, 2**63, 1000).astype(np.uint64)
        k = int(round(1000 * (1 - share) / (1 + share)))
        left = np.unique(np.concatenate([both[k:], rng.integers(0, 2**63, k).astype(np.uint64)]))
        right = np.unique(both)
        true = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
        _, odd = neardup.signatures(np.concatenate([left, right]), np.array([0, len(left), len(left) + len(right)]), plan)
        assert abs(float(neardup.estimate(odd[:1], odd[1:], plan)[0]) - true) < plan.slack


def test_shingle_sets_of_a_block():
    texts = ["", "a b", "A B C D E F", "a b c d e f", "x", "é É é É é É"]
    sets, first = neardup.shingle_sets(*buffers(pa.array(texts)), 5)
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
    assert (sets[first[2] : first[3]] == sets[first[3] : first[4]]).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7), (3, 2)] + [(300, 300 + i) for i in range(40)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100, **{300 + i: 300 for i in range(40)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_link_tables_need_no_passes(spark, monkeypatch):
    """Links that fit one block are settled by their tasks and one more, a larger table by passes; both alike."""
    written = []
    monkeypatch.setattr(components, "stored", lambda df, name, store=components.stored: written.append(name) or store(df, name))
    links = [(i, i + 1) for i in range(300)] + [(1000 + i % 7, 1000 + i) for i in range(200)] + [(None, 3), (4, None)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    expected = {**{i: 0 for i in range(301)}, **{1000 + i: 1000 + i % 7 for i in range(200)}}
    assert dict(components.components(frame).collect()) == expected
    assert len(written) == 2
    assert dict(components.components(frame, block=20).collect()) == expected
    assert len(written) > 4


def test_star_links():
    rng = np.random.default_rng(2)
    for n in (1, 5, 40, 400):
        a, b = rng.integers(0, n + 20, n), rng.integers(0, n + 20, n)
        least = {int(x): int(x) for x in (*a, *b)}
        for _ in range(n):
            for x, y in zip(a.tolist(), b.tolist()):
                least[x] = least[y] = min(least[x], least[y])
        node, root = components.star_links(pa.array(a), pa.array(b))
        assert dict(zip(node.to_pylist(), root.to_pylist())) == {x: r for x, r in least.items() if x != r}
