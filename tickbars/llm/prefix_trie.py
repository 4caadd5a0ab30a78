"""Prefix trie of conversations over a node table with minimal perfect hashing.

1. A turn's mark is the SHA-256 of its role and text. The digest of a prefix is the XOR of 128-bit hashes of (mark,
   place), so a conversation of any length is digested by running XORs over stretches that are dealt out one by one.
   Distinct digests are the nodes. That equal digests have equal parents, places and marks is checked when rows are
   grouped, which by induction rules out collisions.
2. A node's weight is the number of rows (conversation, place) below it, which needs no walk. Where the weight falls below
   a power of ``fan`` times ``rows``, and every ``stretch`` turns, the trie is cut; what hangs together between cuts is a
   piece. One has at most ``rows`` nodes at the bottom and ``fan * stretch`` higher up, however many rows share a prefix.
3. A shard is some whole pieces in one task. Its digests get the slots of a minimal perfect hash function, checked against
   the digests; counts are scattered into flat arrays by slot and added up along the parents' slots, deepest nodes first.
   What hangs below a piece was added to the node it hangs from before: totals of pieces are summed up the tree of
   pieces, which is a few levels high, by pointer doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.shared import column_of, named, stored
from tickbars.llm.spans import U64, mix, seeded

#: Nodes a task gathers, in whole pieces, before it builds one table.
SHARD = 65_536


@dataclass(frozen=True)
class Cut:
    """How turns and tries are dealt; results don't depend on it."""

    turns: int = 4_096
    rows: int = 65_536
    fan: int = 16
    stretch: int = 65_536


def ordered_turns(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", cut: Cut = Cut()
) -> DataFrame:
    """``conv, pos, mark, chars`` of every row: its place in its conversation from 1, digest, and code points of its text.

    Order is by turn, nulls first; rows of one turn go by role and text. Null roles and texts count as empty. Rows without
    id are in no conversation and left out. Other columns are ignored, whatever their names.
    """
    said = turns.select(
        named(id_col).cast("long").alias("conv"),
        named(turn_col).cast("long").alias("turn"),
        F.coalesce(named(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")
    stretch = ["conv", "known", "stretch"]
    dealt = said.select("*", F.expr("int(turn IS NOT NULL) AS known"), F.expr(f"coalesce(turn div {cut.turns}, 0L) AS stretch"))
    within = F.row_number().over(Window.partitionBy(*stretch).orderBy("turn", "role", "text"))
    mark = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    ranked = stored(dealt.select(*stretch, within.alias("k"), mark.alias("mark"), F.length("text").cast("long").alias("chars")), "turns")
    sizes = ranked.groupBy(*stretch).agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("conv").orderBy("known", "stretch"))
    before = sizes.select(*stretch, (so_far - F.col("n")).alias("before"))
    return ranked.join(before, stretch).select("conv", (F.col("before") + F.col("k")).alias("pos"), "mark", "chars")


class SlotTable:
    """Slots 0 .. n-1 of n distinct 128-bit digests: a minimal perfect hash function with the digests to check against.

    Level by level the digests that fall alone into a field get it; the others go on to the next, smaller level.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.uint64, np.ndarray]] = []
        self.keys = np.empty_like(keys)
        left, used = keys, 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("digests repeat")
            seed = seeded(1, 100 + len(self.levels))[0]
            at = self._fields(left, seed, 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left))[at] == 1
            slots = np.full(2 * len(left), -1, np.int64)
            taken = np.sort(at[alone])
            slots[taken] = np.arange(used, used + len(taken))
            self.keys[slots[at[alone]]] = left[alone]
            self.levels.append((seed, slots))
            used += len(taken)
            left = left[~alone]

    @staticmethod
    def _fields(keys: np.ndarray, seed: np.uint64, size: int) -> np.ndarray:
        return (mix(keys[:, 0] ^ mix(keys[:, 1] + seed)) % U64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for digests that aren't in the table."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for seed, slots in self.levels:
            got = slots[self._fields(keys[open_], seed, len(slots))]
            out[open_[got >= 0]] = got[got >= 0]
            open_ = open_[got < 0]
        hit = np.flatnonzero(out >= 0)
        out[hit[(self.keys[out[hit]] != keys[hit]).any(axis=1)]] = -1
        return out


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _digests(table: pa.Table, *names: str) -> np.ndarray:
    return np.stack([_numbers(table, n).astype(np.int64).view(U64) for n in names], axis=1)


OUT = "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def add_up(shard: pa.Table) -> pa.RecordBatch:
    """The nodes of whole pieces with the sums over their subtrees."""
    keys, above, tops = _digests(shard, "d1", "d2"), _digests(shard, "p1", "p2"), _digests(shard, "top1", "top2")
    table = SlotTable(keys)
    slot = table.find(keys)
    is_top = (keys == tops).all(axis=1)
    up = table.find(above)
    up[is_top] = -1
    if (slot < 0).any() or ((up < 0) & ~is_top).any():
        raise RuntimeError("a node's digest or its parent's is missing from its piece")
    n = len(keys)
    parent, depth, first = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    leaves, saved = np.empty(n, np.int64), np.empty(n, np.int64)
    convs, children = _numbers(shard, "n_convs"), _numbers(shard, "n_children")
    parent[slot], depth[slot], first[slot] = up, _numbers(shard, "depth"), _numbers(shard, "first")
    leaves[slot] = (children == 0) + _numbers(shard, "more_leaves")
    saved[slot] = (convs - 1) * _numbers(shard, "chars") + _numbers(shard, "more_saved")
    deepest_first = np.argsort(-depth, kind="stable")
    borders = np.flatnonzero(np.diff(depth[deepest_first])) + 1
    for layer in np.split(deepest_first, borders):
        layer = layer[parent[layer] >= 0]
        np.add.at(leaves, parent[layer], leaves[layer])
        np.add.at(saved, parent[layer], saved[layer])
    outside = shard.column("up_first").combine_chunks()
    inside = pa.array(np.where(up >= 0, first[up], 0), pa.int64(), mask=up < 0)
    at_root = _numbers(shard, "depth") == 0
    names = [x.split()[0] for x in OUT.split(", ")]
    node, over = ([x.tobytes() for x in rows] for rows in (keys, above))
    columns = [
        pa.array(node, pa.binary()),
        pa.array([None if r else x for x, r in zip(over, at_root.tolist(), strict=True)], pa.binary()),
        shard.column("first").combine_chunks(),
        shard.column("depth").combine_chunks(),
        pa.compute.coalesce(inside, outside),
        pa.array(convs, pa.int64()),
        pa.array(children, pa.int64()),
        pa.array(leaves[slot]),
        pa.array(saved[slot]),
        shard.column("ends_sha256").combine_chunks(),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces arrive one after the other; the last one seen may go on, so it waits."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < SHARD:
            continue
        table = pa.Table.from_batches(held)
        changes = np.flatnonzero((np.diff(_digests(table, "top1", "top2"), axis=0) != 0).any(axis=1))
        if len(changes):
            yield add_up(table.slice(0, int(changes[-1]) + 1))
            held = table.slice(int(changes[-1]) + 1).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield add_up(pa.Table.from_batches(held))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, whose strips arrive in order; only the state of one hash is held."""
    names = ["d1", "d2", "ends_sha256"]
    key, state, out = None, None, []

    def flushed() -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        for d1, d2, ids in zip(*(column_of(batch, c).to_pylist() for c in ("d1", "d2", "ids")), strict=True):
            if key != (d1, d2):
                if key:
                    out.append([*key, state.hexdigest()])
                key, state = (d1, d2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield flushed()
        out = []
    if key:
        out.append([*key, state.hexdigest()])
    yield flushed()


def _digested(steps: DataFrame, lengths: DataFrame, cut: Cut) -> DataFrame:
    """``conv, pos, part, length, d1, d2, p1, p2, mark, chars``: digest of the prefix up to each row, and without it."""
    terms = steps.join(lengths, "conv").select(
        "conv", "pos", F.expr(f"(pos - 1) div {cut.stretch} AS part"), "length", "mark", "chars",
        F.xxhash64("mark", "pos").alias("t1"), F.xxhash64("pos", F.lit(7), "mark").alias("t2"),
    )
    terms = stored(terms, "terms")
    parts = terms.groupBy("conv", "part").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("conv", "part", *(F.coalesce(F.bit_xor(f"x{k}").over(earlier), F.lit(0)).alias(f"x{k}") for k in (1, 2)))
    so_far = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    digests = [F.col(f"x{k}").bitwiseXOR(F.bit_xor(f"t{k}").over(so_far)).alias(f"d{k}") for k in (1, 2)]
    rows = terms.join(starts, ["conv", "part"]).select("conv", "pos", "part", "length", "mark", "chars", "t1", "t2", *digests)
    above = [F.col(f"d{k}").bitwiseXOR(F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2)]
    return stored(rows.select("*", *above).drop("t1", "t2"), "prefixes")


def _same(*names: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & (F.min(name) == F.max(name))
    return out


def _nodes(rows: DataFrame, lengths: DataFrame, cut: Cut) -> DataFrame:
    """Every node with its parent's digest, smallest member, counts, and the digest of its piece's top."""
    grouped = rows.groupBy("d1", "d2").agg(
        F.when(_same("pos", "mark", "p1", "p2"), F.min("pos")).otherwise(F.raise_error("digests of prefixes collide").cast("long")).alias("depth"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.min("conv").alias("first"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"),
        F.sum(F.col("length") - F.col("pos") + 1).alias("weight"),
    )
    level = f"CASE WHEN weight <= {cut.rows} THEN 0 ELSE ceil(ln(weight / {cut.rows}) / ln({cut.fan})) END"
    nodes = stored(grouped.withColumn("level", F.expr(level).cast("int")), "nodes")
    path = rows.select("conv", "pos", "part", "d1", "d2").join(nodes.select("d1", "d2", "first", "level"), ["d1", "d2"])
    # Levels only fall along a path, so a level's first row in a stretch is its piece's top.
    run = Window.partitionBy("conv", "part", "level").orderBy("pos")
    tops = path.select("*", F.first("d1").over(run).alias("top1"), F.first("d2").over(run).alias("top2"))
    tops = tops.where("conv = first").select("d1", "d2", "top1", "top2")
    nodes = nodes.join(tops, ["d1", "d2"]).drop("weight", "level")
    root = lengths.agg(F.min("conv").alias("first"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero = ["d1", "d2", "p1", "p2", "depth", "chars", "top1", "top2"]
    nodes = nodes.unionByName(root.select(*(F.lit(0).cast("long").alias(c) for c in zero), "first", "n_convs"))
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    return stored(nodes.join(children, ["d1", "d2"], "left").fillna(0, ["n_children"]), "nodes")


def _totals(nodes: DataFrame) -> DataFrame:
    """``top1, top2, p1, p2, up_first, leaves, saved`` of every piece but the root's: what hangs below its top in all."""
    own = nodes.groupBy("top1", "top2").agg(
        F.sum(F.expr("bigint(n_children = 0)")).alias("leaves"), F.sum(F.expr("(n_convs - 1) * chars")).alias("saved")
    )
    tops = nodes.where("depth > 0 AND d1 = top1 AND d2 = top2").select("top1", "top2", "p1", "p2")
    over = nodes.select(
        F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("first").alias("up_first"),
        F.expr("CASE WHEN depth > 0 THEN top1 END AS up1"), F.expr("CASE WHEN depth > 0 THEN top2 END AS up2"),
    )
    pieces = stored(tops.join(own, ["top1", "top2"]).join(over, ["p1", "p2"]), "pieces")
    state = pieces.select("top1", "top2", "up1", "up2", "leaves", "saved")
    # After k rounds a piece holds the sums of the pieces less than 2^k steps below it, and points 2^k steps up.
    while not state.where("up1 IS NOT NULL").isEmpty():
        gained = state.where("up1 IS NOT NULL").groupBy(F.col("up1").alias("top1"), F.col("up2").alias("top2"))
        gained = gained.agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        jumps = state.select(F.col("top1").alias("up1"), F.col("top2").alias("up2"), F.col("up1").alias("far1"), F.col("up2").alias("far2"))
        now = state.join(gained, ["top1", "top2"], "left").join(jumps, ["up1", "up2"], "left")
        state = stored(
            now.select(
                "top1", "top2", F.col("far1").alias("up1"), F.col("far2").alias("up2"),
                F.expr("leaves + coalesce(l, 0) AS leaves"), F.expr("saved + coalesce(s, 0) AS saved"),
            ),
            "pieces",
        )
    return pieces.select("top1", "top2", "p1", "p2", "up_first").join(state.select("top1", "top2", "leaves", "saved"), ["top1", "top2"])


def _ends(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """``d1, d2, ends_sha256`` of nodes where conversations end. Ids go in strips of 4,096 numbers, so the one task that
    must hash a node's ids in order gets few rows."""
    zero = F.lit(0).cast("long")
    ends = rows.where("pos = length").select("d1", "d2", "conv")
    ends = ends.unionByName(lengths.where("length = 0").select(zero.alias("d1"), zero.alias("d2"), "conv"))
    ids = F.expr("array_join(transform(array_sort(collect_list(conv)), c -> string(c)), ',')")
    strips = ends.groupBy("d1", "d2", F.shiftright("conv", 12).alias("strip")).agg(ids.alias("ids"))
    strips = strips.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "strip")
    return strips.select("d1", "d2", "ids").mapInArrow(_hash_ends, "d1 long, d2 long, ends_sha256 string")


def prefix_trie(steps: DataFrame, lengths: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """One row per distinct prefix of the conversations, from the empty one (the root) on.

    ``steps`` has ``conv, pos, mark, chars`` (places 1, 2, ... without gaps, as ``ordered_turns`` gives), ``lengths`` one
    row ``conv, length`` per conversation, those without turns included. A node has: ``node`` and ``parent`` (digests; the
    root's parent is null), ``conv_id`` and ``parent_conv_id`` (smallest members), ``depth``, ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes of its subtree, itself included), ``saved_tokens`` (over its subtree,
    members but one times the code points of the node's last text) and ``ends_sha256`` (of the ids of members that end
    here, ascending, comma-joined).

    Conversations that are alike in all turns are members of the same nodes; texts of any length count by their digest;
    no conversations give no rows. Tables between the steps are written to the shared folder while this is built. Only
    the digest of a node's ids runs through one task, by the nature of SHA-256, and holds one state there.
    """
    lengths = stored(lengths.select("conv", F.col("length").cast("long")), "lengths")
    rows = _digested(steps, lengths, cut)
    nodes = _nodes(rows, lengths, cut)
    totals = stored(_totals(nodes), "totals")
    hung = totals.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2"))
    hung = hung.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    over = totals.select(F.col("top1").alias("d1"), F.col("top2").alias("d2"), "up_first")
    ready = nodes.join(hung, ["d1", "d2"], "left").join(over, ["d1", "d2"], "left").join(_ends(rows, lengths), ["d1", "d2"], "left")
    ready = ready.fillna(0, ["more_leaves", "more_saved"]).fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
    return ready.repartition("top1", "top2").sortWithinPartitions("top1", "top2").mapInArrow(_add_up, OUT)
