"""N-gram Jaccard join that uses relations between sets.

1. Every text becomes the set of its word shingles (as 64-bit hashes). Equal sets are one class from here on. Shingles are
   ordered rare before common, by counters of fixed size; a class enters the lists of its rarest shingles, of which two
   sets of the asked similarity must share one.
2. *Block skipping*: a list's entries of one set size and one position in their set are a block. Sizes and positions bound
   what two sets can share from there on, so blocks that offer too little are skipped as a whole. In short lists the pairs of
   the blocks that are left are compared on full sets.
3. *Derived answers*: in long lists everyone is compared with one leader only, and what either side has beyond the other is
   kept. The answers of others follow from the leader's: with ``missing`` and ``extra`` against leader l, sets x and z share
   |l| - |missing x + missing z| + |extra x and extra z|. Who joined the leader's component needs no comparison with its
   other members, and only those are looked at that a block of another component can still match.

No pairs are formed within a group of near copies: members of one component aren't compared any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.lookup import texts_by_id
from tickbars.llm.neardup import fingerprints, shingle_sets
from tickbars.llm.shared import blocks, column_of, named, stored, texts_of
from tickbars.llm.spans import U64, buffers, mix

BLOCK = 1_000_000


@dataclass(frozen=True)
class Plan:
    """Links need ``percent`` similarity; the other figures steer the work only."""

    percent: int = 90
    shingle: int = 3
    #: Lists up to this length compare their blocks directly, longer ones by leaders.
    short: int = 16
    #: Open members outside a list's largest component that are compared with all open members at once.
    few: int = 128
    #: Counters of shingle frequencies.
    counters: int = 1 << 18

    def wanted(self, total):
        """Shared shingles that sets with ``total`` shingles in sum must have."""
        return -(-self.percent * total // (100 + self.percent))

    def feasible(self, n1: str, p1: str, n2: str, p2: str) -> Column:
        """Whether sets that share no shingle before these places can share enough."""
        return F.expr(f"least({n1} - {p1}, {n2} - {p2}) >= ceil({self.percent} * ({n1} + {n2}) / {100 + self.percent})")


def parities(shingles: np.ndarray, first: np.ndarray) -> list[bytes]:
    """A bitmap of each set where every shingle flips one bit; it has four bits a shingle or more, a power of two in all.

    Two bitmaps differ in as many bits as their sets differ in shingles at most, which rules out pairs without any error.
    """
    n = np.diff(first)
    bits = 1 << np.ceil(np.log2(np.maximum(4 * n, 512))).astype(np.int64)
    start = np.cumsum(bits) - bits
    cells = np.repeat(start, n) + (mix(shingles) & np.repeat(bits - 1, n).astype(U64)).astype(np.int64)
    packed = np.packbits((np.bincount(cells, minlength=int(bits.sum())) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : (a + b) // 8] for a, b in zip(start.tolist(), bits.tolist(), strict=True)]


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ; the larger one is folded, which flips bits as the smaller size would have."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _count(plan: Plan):
    """Each task's counts of shingles, by counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(plan.counters, np.int64)
        for block in blocks(batches, limit=BLOCK):
            shingles, _ = shingle_sets(*buffers(texts_of(block)), plan.shingle)
            counts += np.bincount((shingles % U64(plan.counters)).astype(np.int64), minlength=plan.counters)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["counter", "n"])

    return run


def _sign(plan: Plan, shared):
    """Size, class, commonness and rarest shingles (in order) of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for block in blocks(batches, limit=BLOCK):
            shingles, first = shingle_sets(*buffers(texts_of(block)), plan.shingle)
            n = np.diff(first)
            text = np.repeat(np.arange(len(n)), n)
            common = counts[(shingles % U64(plan.counters)).astype(np.int64)]
            ordered = shingles[np.lexsort((common, text))].view(np.int64)  # stable: ties stay in order of their hashes
            # Sets that aren't equal differ in one shingle at least, so small ones are never similar enough.
            able = n * (100 - plan.percent) >= plan.percent
            kept = np.where(able, n - -(-plan.percent * n // 100) + 1, 0)
            inside = np.arange(len(ordered)) - np.repeat(first[:-1], n) < np.repeat(kept, n)
            rare = pa.ListArray.from_arrays(np.append(0, np.cumsum(kept)).astype(np.int32), pa.array(ordered[inside]))
            sums = np.append(0.0, np.cumsum(np.log1p(common)))
            rarity = -1e6 * (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)
            columns = [column_of(block, "__id"), pa.array(n), pa.array(fingerprints(shingles, first), pa.binary()), pa.array(rarity.astype(np.int64)), rare]
            columns.append(pa.array(parities(shingles, first), pa.binary(), mask=~able))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "node", "rarity", "rare", "parity"])

    return run


def _sets(plan: Plan):
    """The sets of texts, where they still are what the class stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            shingles, first = shingle_sets(*buffers(texts_of(block)), plan.shingle)
            nodes = column_of(block, "node").to_pylist()
            same = [i for i, (a, b) in enumerate(zip(fingerprints(shingles, first), nodes, strict=True)) if a == b]
            raw = [shingles[first[i] : first[i + 1]].tobytes() for i in same]
            yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in same], pa.binary()), pa.array(raw, pa.binary())], names=["node", "shingles"])

    return run


def block_pairs(starts: np.ndarray, n: np.ndarray, place: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Entries (i > j) of the same list whose blocks can match; ``starts`` are the lists' ranges."""
    lists = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((n, place, lists))
    key = np.stack([lists, place, n])[:, order]
    heads = np.flatnonzero(np.append(True, (np.diff(key, axis=1) != 0).any(axis=0))) if len(lists) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(lists)))
    block_list, block_place, block_n = key[:, heads]
    # Each block with itself and those before it in its list.
    first = np.searchsorted(block_list, block_list)
    many = np.arange(len(heads)) - first + 1
    right = np.repeat(np.arange(len(heads)), many)
    left = np.arange(len(right)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    offer = np.minimum(block_n[left] - block_place[left], block_n[right] - block_place[right])
    match = offer >= plan.wanted(block_n[left] + block_n[right])
    match &= (left != right) | (size[right] > 1)
    left, right = left[match], right[match]
    pairs = size[left] * size[right]
    at = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    wide = np.repeat(size[right], pairs)
    i, j = np.repeat(heads[left], pairs) + at // wide, np.repeat(heads[right], pairs) + at % wide
    once = (i < j) | (np.repeat(left, pairs) != np.repeat(right, pairs))
    return order[j[once]], order[i[once]]


def _short_pairs(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = column_of(batch, "entries")
            flat = entries.flatten()
            starts = np.append(0, np.cumsum(entries.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
            n, place = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "place"))
            i, j = block_pairs(starts, n, place, plan)
            nodes = flat.field("node")
            a, b = nodes.take(pa.array(i)), nodes.take(pa.array(j))
            swap = pa.compute.less(a, b)
            columns = [pa.compute.if_else(swap, b, a), pa.compute.if_else(swap, a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return run


def _near(plan: Plan):
    """Pairs whose bitmaps don't rule them out. Pairs with a leader stay up to twice the distance of a link, as everyone that
    someone linked with the leader is linked with lies within that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n_a, n_b, x, y, lead in zip(*(column_of(batch, c).to_pylist() for c in ("n_a", "n_b", "parity_a", "parity_b", "lead")), strict=True):
                apart = n_a + n_b - 2 * plan.wanted(n_a + n_b)
                good.append(differing_bits(x, y) <= apart * (2 if lead else 1))
            yield batch.select(["a", "b", "lead"]).filter(pa.array(good, pa.bool_()))

    return run


def _compare(plan: Plan):
    """Whether a and b are linked; of pairs with a leader b, what a misses and has beyond b, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, missing, extra = [], [], []
            for x, y, lead in zip(*(column_of(batch, c).to_pylist() for c in ("set_a", "set_b", "lead")), strict=True):
                a, b = np.frombuffer(x, U64), np.frombuffer(y, U64)
                shared = np.intersect1d(a, b, assume_unique=True)
                good.append(len(shared) >= plan.wanted(len(a) + len(b)))
                missing.append(np.setdiff1d(b, shared, assume_unique=True).tobytes() if lead else None)
                extra.append(np.setdiff1d(a, shared, assume_unique=True).tobytes() if lead else None)
            out = [column_of(batch, "a"), column_of(batch, "b"), column_of(batch, "lead")]
            out += [pa.array(good, pa.bool_()), pa.array(missing, pa.binary()), pa.array(extra, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=["a", "b", "lead", "linked", "missing", "extra"])

    return run


def shared_by_leader(n_lead: int, missing_a, extra_a, missing_b, extra_b) -> int:
    """Shingles that two sets share, from what they miss and have beyond a third one."""
    both = len(np.intersect1d(missing_a, missing_b, assume_unique=True))
    return n_lead - len(missing_a) - len(missing_b) + both + len(np.intersect1d(extra_a, extra_b, assume_unique=True))


def _derive(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lead_n", "n_a", "n_b", "missing_a", "extra_a", "missing_b", "extra_b"]
        for batch in batches:
            good = []
            for n_lead, n_a, n_b, *raw in zip(*(column_of(batch, c).to_pylist() for c in names), strict=True):
                shared = shared_by_leader(n_lead, *(np.frombuffer(x or b"", U64) for x in raw))
                good.append(shared >= plan.wanted(n_a + n_b))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


class _Join:
    """One run over the classes of a corpus: ``reps`` has node, id, n, rarity, rare, parity; ``only`` the texts by id."""

    def __init__(self, only: DataFrame, reps: DataFrame, plan: Plan):
        self.only, self.reps, self.plan = only, reps, plan

    def components(self) -> DataFrame:
        """``node, root`` of every class that has a link."""
        plan = self.plan
        entries = self.reps.select("node", "n", "rarity", F.posexplode("rare").alias("place", "token"))
        best = F.min(F.struct("rarity", "node", "n")).alias("best")
        lists = entries.groupBy("token").agg(F.count("*").alias("size"), best).where("size > 1")
        lists = stored(lists.select("token", "size", F.col("best.node").alias("lead"), F.col("best.n").alias("lead_n")), "lists")
        entries = stored(entries.join(lists, "token").drop("rarity"), "entries")
        listed = entries.where(F.col("size") <= plan.short).groupBy("token").agg(F.collect_list(F.struct("node", "n", "place")).alias("entries"))
        direct = listed.select("entries").mapInArrow(_short_pairs(plan), "a binary, b binary").withColumn("lead", F.lit(False))
        long = entries.where(F.col("size") > plan.short)
        # Someone within twice the distance of a link from the leader isn't much smaller or larger, either.
        led = long.where("node <> lead").where(f"100 * least(n, lead_n) >= {2 * plan.percent - 100} * greatest(n, lead_n)")
        led = led.select(F.col("node").alias("a"), F.col("lead").alias("b"), F.lit(True).alias("lead"))
        pairs = stored(self.near(direct.unionByName(led).groupBy("a", "b").agg(F.max("lead").alias("lead"))), "pairs")
        answers = stored(self.compared(pairs), "answers")
        found = components(answers.where("linked").select("a", "b"))
        return self.open_lists(long.drop("size"), answers.where("lead"), found)

    def near(self, pairs: DataFrame) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(self.reps.select(*(F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "parity"))).withColumnRenamed(f"node_{side}", side), side)
        return pairs.select("a", "b", "lead", "n_a", "n_b", "parity_a", "parity_b").mapInArrow(_near(self.plan), "a binary, b binary, lead boolean")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """The answers to ``pairs`` by full sets, which are made anew from the texts of the classes asked for."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = stored(nodes.join(self.reps.select("node", F.col("id").alias("rep")), "node"), "wanted")
        texts = texts_by_id(self.only, wanted)
        sets = texts.select("__text", "node").mapInArrow(_sets(self.plan), "node binary, shingles binary")
        # Repeated rows of one document bring its set several times; any of them will do.
        sets = stored(sets.dropDuplicates(["node"]), "sets")
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "lead", "set_a", "set_b")
        return both.mapInArrow(_compare(self.plan), "a binary, b binary, lead boolean, linked boolean, missing binary, extra binary")

    def open_blocks(self, known: DataFrame) -> DataFrame:
        """Blocks ``token, n, place, root`` with ``entries`` that a block of another component in their list can match.

        Per list and size, the block that offers most and the best one of another component tell about all blocks.
        """
        found = known.groupBy("token", "n", "place", "root").agg(F.count("*").alias("entries"))
        offers = found.groupBy("token", "n", "root").agg((F.col("n") - F.min("place")).alias("left"))
        rank = F.row_number().over(Window.partitionBy("token", "n").orderBy(F.desc("left"), "root"))
        offers = offers.withColumn("rank", rank).where("rank <= 2").groupBy("token")
        offers = offers.agg(F.collect_list(F.struct(F.col("n").alias("m"), "root", "left")).alias("offers"))
        match = f"exists(offers, o -> o.root <> root AND least(n - place, o.left) >= ceil({self.plan.percent} * (n + o.m) / {100 + self.plan.percent}))"
        return found.join(offers, "token").where(match).drop("offers")

    def open_lists(self, members: DataFrame, answers: DataFrame, found: DataFrame) -> DataFrame:
        """Components once every pair of the long lists that matter was derived from their leaders' answers.

        Where few open members lie outside a list's largest open component, they are held against all open members; each
        open pair has one of them. Else some of them are, more in each round, until few are left.
        """
        seekers_each = 4
        while True:
            known = stored(members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "known")
            open_ = self.open_blocks(known)
            by_root = open_.groupBy("token", "root").agg(F.sum("entries").alias("entries")).groupBy("token")
            major = by_root.agg(F.max_by("root", F.struct("entries", "root")).alias("major"), (F.sum("entries") - F.max("entries")).alias("minors"))
            open_ = open_.select("token", "n", "place", "root").join(major, "token")
            alive = stored(known.join(open_, ["token", "n", "place", "root"]), "open")
            if alive.isEmpty():
                return found
            outside = alive.where("root <> major")
            part = F.pmod(F.xxhash64("node"), F.lit(seekers_each))
            some = outside.where(F.col("minors") > self.plan.few).groupBy("token", part.alias("part"))
            some = some.agg(F.min(F.struct("node", "n", "place", "root")).alias("x")).select("token", "x.*")
            seekers = stored(outside.where(F.col("minors") <= self.plan.few).select("token", "node", "n", "place", "root").unionByName(some), "seekers")
            other = seekers.select("token", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "place", "root")))
            asked = alive.join(other, "token").where("root <> root_b").where(self.plan.feasible("n", "place", "n_b", "place_b"))
            swap = "node < node_b"
            pairs = asked.select(
                F.expr(f"IF({swap}, node_b, node) AS a"), F.expr(f"IF({swap}, node, node_b) AS b"),
                F.expr(f"IF({swap}, n_b, n) AS n_a"), F.expr(f"IF({swap}, n, n_b) AS n_b"), "lead", "lead_n",
            ).dropDuplicates(["a", "b"])
            left, right = (
                answers.select(F.col("a").alias(s), F.col("b").alias("lead"), F.col("missing").alias(f"missing_{s}"), F.col("extra").alias(f"extra_{s}"))
                for s in "ab"
            )
            both = pairs.join(left, ["a", "lead"], "left").join(right, ["b", "lead"], "left")
            both = both.withColumn("told", F.expr("(a = lead OR missing_a IS NOT NULL) AND (b = lead OR missing_b IS NOT NULL)"))
            both = stored(both, "asked")
            links = both.where("told").select("a", "b", "lead_n", "n_a", "n_b", "missing_a", "extra_a", "missing_b", "extra_b")
            more = links.mapInArrow(_derive(self.plan), "a binary, b binary")
            # Who is too far from the leader has no answer to derive from.
            untold = both.where("NOT told").select("a", "b", F.lit(False).alias("lead"))
            if not untold.isEmpty():
                untold = stored(self.near(untold), "untold")
                if not untold.isEmpty():
                    more = more.unionByName(self.compared(untold).where("linked").select("a", "b"))
            more = stored(more, "links")
            if not more.isEmpty():
                found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
            crowded = alive.where(F.col("minors") > self.plan.few)
            members = crowded.join(seekers.select("token", "node"), ["token", "node"], "anti").select(members.columns)
            if crowded.isEmpty():
                return found
            seekers_each = min(4 * seekers_each, 64)


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``id_col, n_shingles, component_id`` of every row.

    Words are runs of bytes other than ASCII white space, A-Z as a-z. A text's set is its distinct ``shingle``-word
    windows, or its whole word sequence if shorter. Sets of ``percent`` similarity or more are linked; ``component_id`` is
    the smallest id of a row reachable by links, itself included.

    Null texts and texts without words have the empty set and are linked with nothing. Rows with equal sets are one class
    whether or not they share an id; rows that share an id aren't linked for that. Null ids come last; a component of null
    ids alone keeps them. Ties between equally rare shingles go by their hashes. Texts of any length count whole; other
    columns are ignored; an empty table gives no rows.

    Runs jobs while it is built: classes, lists, sets of compared classes and answers are written to the shared folder.
    """
    only = docs.select(named(id_col).alias("__id"), named(text_col).cast("string").alias("__text"))
    kind = only.schema["__id"].dataType.simpleString()
    totals = only.select("__text").mapInArrow(_count(plan), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counts = np.zeros(plan.counters, np.int64)
    for row in totals.toLocalIterator():  # as many rows as counters at most
        counts[row.counter] = row.n
    shared = only.sparkSession.sparkContext.broadcast(counts)
    signed = stored(only.mapInArrow(_sign(plan, shared), f"id {kind}, n long, node binary, rarity long, rare array<bigint>, parity binary"), "classes")
    firsts = [F.first(c).alias(c) for c in ("n", "rarity", "rare", "parity")]
    reps = stored(signed.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), *firsts), "classes")
    roots = _Join(only, reps.where("size(rare) > 0"), plan).components()
    linked = reps.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    label = linked.join(best, "root").select("node", "component_id")
    out = signed.select("id", "n", "node").join(label, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
