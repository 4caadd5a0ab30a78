"""The conversation trie beside a plain walk over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tickbars.llm import prefix_trie, queries_prefix_trie
from tickbars.llm.spans import U64

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def gathered(rows):
    """(id, turn, role, text) rows to id -> turns in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def plain(convs):
    """The rows of all nodes, by walking every prefix of every conversation."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = own + sum(saved[x] for x in below)
    out = []
    for node, own in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), parent, len(own), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def built(frame, cut=prefix_trie.Cut()):
    """The trie of conversations as they are."""
    from pyspark.sql import functions as F

    steps = prefix_trie.ordered_turns(frame, cut=cut)
    lengths = steps.groupBy("conv").agg(F.count("*").alias("length"))
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(steps, lengths, cut).collect()), key=repr)


def chatter(rng, n, words="abc", longest=9):
    rows = []
    for c in rng.sample(range(5 * n), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("cut", [prefix_trie.Cut(), prefix_trie.Cut(turns=2, rows=3, fan=2, stretch=3)], ids=["whole", "pieces"])
def test_random_conversations(spark, cut):
    """Shared prefixes of all lengths, in one piece and cut into very many."""
    rng = random.Random(11)
    rows = chatter(rng, 150)
    rows += [(9000 + k, t, "user", "z" * (t + 1)) for k in range(40) for t in range(k % 13)]
    rng.shuffle(rows)
    assert built(spark.createDataFrame(rows, SCHEMA), cut) == plain(gathered(rows))


def test_edge_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, "user", "next"), (1, -5, None, None), (2, None, "user", "first"), (2, 7, None, ""),
        (3, 1, "a", "é\U0001f600"), (3, 1, "a", "é\U0001f600"), (3, 1, "b", None), (None, 1, "a", "nobody's"), (-4, 0, "ab", "c"), (5, 0, "a", "bc"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "1 AS pos", "2 AS known", "3 AS mark")
    assert built(frame) == plain(gathered(rows))
    assert built(frame.limit(0)) == []


def test_long_and_hot_conversations(spark):
    """One conversation with most rows, one very long text, and one conversation that hundreds repeat."""
    rows = [(7, t, "user", f"turn {t}") for t in range(3_000)] + [(8, t, "user", f"turn {t}") for t in range(1_500)]
    rows += [(100 + k, t, "bot", f"again {t}") for k in range(400) for t in range(3)] + [(9, 0, "user", "x" * 500_000)]
    cut = prefix_trie.Cut(turns=256, rows=500, fan=4, stretch=700)
    assert built(spark.createDataFrame(rows, SCHEMA), cut) == plain(gathered(rows))


def test_query_rebuilds(spark, table_dir):
    """Groups with and without a first conversation, shorter ones than their head, and ones that become turnless."""
    rng = random.Random(2)
    rows = []
    for c in [0, 3, 7, 99, 100, 105, 150, 303, 311, 350, 420, 421, 777, 1200, 1299, 5001]:
        for turn in range(rng.randrange(1, 8)):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", None]), rng.choice(["a", "bb", None])))
    convs = rebuilt(gathered(rows))
    assert any(not t for t in convs.values())
    folder = table_dir(conversations=spark.createDataFrame(rows, SCHEMA))
    got = queries_prefix_trie.op11_conversation_prefix_trie(spark, folder).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == plain(convs)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries_prefix_trie.op11_conversation_prefix_trie(spark, sf_dir)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rebuilt(gathered(rows)))


@pytest.mark.parametrize("n", [1, 2, 100, 20_000])
def test_slots(n):
    """Every digest has a slot of its own below n; others have none, also where they fall into a taken field."""
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, (n, 2)).astype(U64)
    keys[: n // 2, 0] = keys[0, 0]
    table = prefix_trie.SlotTable(keys)
    assert sorted(table.find(keys).tolist()) == list(range(n))
    assert (table.find(rng.integers(0, 2**63, (5 * n, 2)).astype(U64)) == -1).all()


def test_repeated_digests_are_refused():
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.zeros((2, 2), U64))
