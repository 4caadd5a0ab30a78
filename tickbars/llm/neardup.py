"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation, components.

1. Every text becomes the set of its 5-word shingles (as 64-bit hashes), a MinHash signature cut into bands, and an odd
   sketch: a bitmap where each sample flips one bit. Two sketches' XOR has one bit for about every sample that differs,
   so its population count tells high similarities much better than a few equal bands do. Equal sets are one class, and
   one member stands for it from here on.
2. Classes that share a band are candidates. In small buckets every pair is formed. Classes of larger buckets are dealt
   out again by the rare shingles that two sets of the asked similarity must share (prefix filter, with bounds from sizes
   and positions); an outlier's rare shingles are its own, so it meets nobody. Where such a bucket is large still, all
   compare with one leader, then with more, until no bucket has two components left.
3. Candidates whose sketches are far apart are dropped, the others are confirmed on the full sets, and links joined to
   components. Nothing here grows with the square of a group: a bucket's pairs are formed up to a fixed size only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.llm.components import components
from tickbars.llm.lookup import texts_by_id
from tickbars.llm.shared import blocks, column_of, named, stored, texts_of
from tickbars.llm.spans import LOWERED_VALUES, U64, buffers, find_words, mix, seeded, span_hashes, window_hashes, windows

BLOCK = 1_000_000


@dataclass(frozen=True)
class Plan:
    """Links need ``percent`` similarity. ``bands`` x ``rows`` MinHash samples: at 85 % a pair shares no band with a
    chance of 3 in 10 million. ``slack`` is about six standard errors of the sketch estimate."""

    percent: int = 85
    shingle: int = 5
    bands: int = 32
    rows: int = 6
    sketch_bits: int = 1024
    slack: float = 0.15
    #: Up to so many classes in a bucket all pairs are formed; and, after a round, with up to so many outside the
    #: bucket's largest component.
    small: int = 8
    few: int = 128
    #: Counters of shingle frequencies that order rare before common; only the work depends on them.
    counters: int = 1 << 18

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def linked(self, shared: np.ndarray, total: np.ndarray) -> np.ndarray:
        return 100 * shared >= self.percent * (total - shared)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, first of each text) of a block of texts."""
    words = find_words(data, offsets)
    hashes = span_hashes(data, words.start, words.end, LOWERED_VALUES)
    at, _ = windows(words.first, size)
    grams = window_hashes(hashes, at, size)
    counts = words.counts
    ends = np.cumsum(np.maximum(counts - size + 1, 0))
    sets: list[np.ndarray] = []
    for i, n in enumerate(counts.tolist()):
        if n >= size:
            sets.append(np.unique(grams[ends[i] - (n - size + 1) : ends[i]]))
        elif n:
            sets.append(window_hashes(hashes, words.first[i : i + 1], n))
        else:
            sets.append(np.zeros(0, U64))
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, U64), first


def fingerprints(shingles: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128 bits that tell sets apart; none for the empty set."""
    filled = np.flatnonzero(np.diff(first))
    out: list[bytes | None] = [None] * (len(first) - 1)
    if len(filled):
        sums = [np.add.reduceat(mix(shingles ^ key), first[filled]) for key in seeded(2, 3)]
        for i, pair in zip(filled.tolist(), np.stack(sums, 1), strict=True):
            out[i] = pair.tobytes()
    return out


def signatures(shingles: np.ndarray, first: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, odd sketches as bytes) of the non-empty sets, one row each."""
    heads = first[:-1][np.diff(first) > 0]
    samples = np.empty((len(heads), plan.samples), U64)
    flips, odd = seeded(plan.samples, 5), seeded(plan.samples, 6) | U64(1)
    work = np.empty_like(shingles)
    for k in range(plan.samples):
        np.bitwise_xor(shingles, flips[k], out=work)
        np.multiply(work, odd[k], out=work)
        samples[:, k] = np.minimum.reduceat(work, heads)
    bands = np.empty((len(heads), plan.bands), U64)
    for b in range(plan.bands):
        own = samples[:, b * plan.rows : (b + 1) * plan.rows].ravel()
        bands[:, b] = window_hashes(own, np.arange(len(heads)) * plan.rows, plan.rows) ^ U64(b)
    bit = (mix(samples ^ seeded(plan.samples, 8)) % U64(plan.sketch_bits)).astype(np.int64)
    cells = (bit + np.arange(len(heads))[:, None] * plan.sketch_bits).ravel()
    counts = np.bincount(cells, minlength=len(heads) * plan.sketch_bits).reshape(len(heads), plan.sketch_bits)
    return mix(bands), np.packbits((counts & 1).astype(np.uint8), axis=1)


def estimate(a: np.ndarray, b: np.ndarray, plan: Plan) -> np.ndarray:
    """Similarity from pairs of odd sketches (rows of bytes)."""
    differ = np.bitwise_count(a ^ b).sum(axis=1)
    share = np.minimum(2 * differ / plan.sketch_bits, 1 - 1e-9)
    return 1 + plan.sketch_bits / (4 * plan.samples) * np.log1p(-share)


def _sign(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            shingles, first = shingle_sets(*buffers(texts_of(block)), plan.shingle)
            nodes = fingerprints(shingles, first)
            filled = [i for i, node in enumerate(nodes) if node]
            keys: list = [None] * len(nodes)
            odd: list = [None] * len(nodes)
            if filled:
                bands, sketches = signatures(shingles, first, plan)
                for i, band, sketch in zip(filled, bands.view(np.int64), sketches, strict=True):
                    keys[i], odd[i] = band.tolist(), sketch.tobytes()
            columns = [pa.array(np.diff(first)), pa.array(nodes, pa.binary())]
            columns += [pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.binary())]
            own = [column_of(block, c) for c in ("__id", "k1", "k2")]
            yield pa.RecordBatch.from_arrays([*own, *columns], names=["id", "k1", "k2", "n", "node", "bands", "sketch"])

    return run


def _sets(size: int):
    """The sets of texts, where they still are what the node stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            shingles, first = shingle_sets(*buffers(texts_of(block)), size)
            nodes = column_of(block, "node").to_pylist()
            same = [i for i, (a, b) in enumerate(zip(fingerprints(shingles, first), nodes, strict=True)) if a == b]
            raw = [shingles[first[i] : first[i + 1]].tobytes() for i in same]
            own = [column_of(block, c).take(pa.array(same, pa.int64())) for c in ("node", "crowded")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(raw, pa.binary())], names=["node", "crowded", "shingles"])

    return run


def _bytes_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _near(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = estimate(_bytes_matrix(column_of(batch, "sketch_a")), _bytes_matrix(column_of(batch, "sketch_b")), plan)
                batch = batch.select(["a", "b"]).filter(pa.array(100 * (values + plan.slack) >= plan.percent))
            yield batch.select(["a", "b"])

    return run


def _confirm(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [column_of(batch, c).to_pylist() for c in ("set_a", "set_b")]
            good = []
            for x, y in zip(*sides, strict=True):
                a, b = np.frombuffer(x, U64), np.frombuffer(y, U64)
                shared = len(a) + len(b) - len(np.union1d(a, b))
                good.append(bool(plan.linked(shared, len(a) + len(b))))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _frequencies(plan: Plan):
    """Each task's counts of shingles, by counter, as one array of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(plan.counters, np.int64)
        for batch in batches:
            for raw in column_of(batch, "shingles").to_pylist():
                np.add.at(counts, np.frombuffer(raw, U64) % U64(plan.counters), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["counter", "n"])

    return run


def _prefixes(plan: Plan, shared):
    """Rare shingles of every set that a linked set must share one of: shingle, node, size, position, and how far the
    whole set is from common shingles; the text that a group's others were made from has the least of that."""
    names = ["bucket", "node", "n", "place", "rarity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            nodes, shingles, sizes, places, rarities = [], [], [], [], []
            for node, raw in zip(*(column_of(batch, c).to_pylist() for c in ("node", "shingles")), strict=True):
                own = np.frombuffer(raw, U64)
                common = counts[own % U64(plan.counters)]
                rarity = -int(1e6 * np.log1p(common).mean())
                own = own[np.lexsort((own, common))]
                n = len(own)
                long = n + (-plan.percent * n // 100) + 1  # n - ceil(share of n) + 1
                shingles.append(own[:long])
                places.append(np.arange(long))
                sizes.append(np.full(long, n))
                rarities.append(np.full(long, rarity))
                nodes += [node] * long
            joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (shingles, sizes, places, rarities)]
            columns = [pa.array(joined[0].view(np.int64)), pa.array(nodes, pa.binary()), *(pa.array(x.astype(np.int64)) for x in joined[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


class Search:
    """One run over the classes of a corpus; ``reps`` has a row per class: node, id, n, bands, sketch."""

    def __init__(self, only: DataFrame, reps: DataFrame, plan: Plan):
        self.only, self.reps, self.plan = only, reps, plan

    def pairs_within(self, members: DataFrame) -> DataFrame:
        """All pairs ``a, b`` of buckets that have ``small`` members at most."""
        listed = members.groupBy("bucket").agg(F.collect_list("node").alias("nodes"))
        one = listed.select(F.explode("nodes").alias("a"), "nodes").select("a", F.explode("nodes").alias("b"))
        return one.where("a > b").distinct()

    def feasible(self, n1: str, p1: str, n2: str, p2: str):
        """Whether sets that share a shingle at these places can have the asked similarity."""
        wanted = f"ceil({self.plan.percent} * ({n1} + {n2}) / {100 + self.plan.percent})"
        return F.expr(f"least({n1} - {p1}, {n2} - {p2}) >= {wanted}")

    def near(self, pairs: DataFrame) -> DataFrame:
        sketches = self.reps.select("node", "sketch")
        left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
        right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")
        return both.mapInArrow(_near(self.plan), "a binary, b binary")

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
        return both.mapInArrow(_confirm(self.plan), "a binary, b binary")

    def links(self) -> DataFrame:
        """Component ``node, root`` of every class that has a link."""
        plan = self.plan
        bands = self.reps.select("node", F.explode("bands").alias("bucket"))
        # Stored, so that the join's sides are plain shuffles and a crowded bucket's can be split.
        sizes = stored(bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        members = stored(bands.join(sizes, "bucket"), "buckets")
        few = stored(self.near(self.pairs_within(members.where(F.col("size") <= plan.small))), "pairs")
        crowded = members.where(F.col("size") > plan.small).select("node", F.lit(True).alias("crowded"))
        paired = few.select(F.explode(F.array("a", "b")).alias("node"), F.lit(False).alias("crowded"))
        nodes = paired.unionByName(crowded).groupBy("node").agg(F.max("crowded").alias("crowded"))
        wanted = stored(nodes.join(self.reps.select("node", F.col("id").alias("rep")), "node"), "wanted")
        texts = texts_by_id(self.only, wanted)
        # Repeated rows of one document bring its set several times; any of them will do.
        sets = texts.select("__text", "node", "crowded").mapInArrow(_sets(plan.shingle), "node binary, crowded boolean, shingles binary")
        sets = stored(sets.dropDuplicates(["node"]), "sets")
        crowd = sets.where("crowded")

        counts = np.zeros(plan.counters, np.int64)
        totals = crowd.mapInArrow(_frequencies(plan), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
        for row in totals.toLocalIterator():  # as many rows as counters at most
            counts[row.counter] = row.n
        shared = self.only.sparkSession.sparkContext.broadcast(counts)
        prefix = crowd.mapInArrow(_prefixes(plan, shared), "bucket long, node binary, n long, place long, rarity long")
        sizes = stored(prefix.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        prefix = stored(prefix.join(sizes, "bucket"), "prefixes")
        little = self.near(self.pairs_within(prefix.where(F.col("size") <= plan.small)))
        links = stored(self.confirmed(few.unionByName(little), sets), "links")
        rest = prefix.where(F.col("size") > plan.small).drop("size")
        return self.by_leaders(rest, links, sets)

    def open_members(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """Members, with ``root``, that some member of their bucket in another component can still match.

        Per bucket and set size the largest number of shingles from the place on is kept, and the largest of another
        component. That is exact: no other member offers more, so a member that fails against all sizes matches nobody.
        """
        known = stored(members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "known")
        rest = known.groupBy("bucket", "n", "root").agg(F.max(F.col("n") - F.col("place")).alias("left"))
        rank = F.row_number().over(Window.partitionBy("bucket", "n").orderBy(F.desc("left"), "root"))
        best = rest.withColumn("rank", rank).where("rank <= 2")
        offers = best.groupBy("bucket").agg(F.collect_list(F.struct(F.col("n").alias("m"), "root", "left")).alias("offers"))
        offers = stored(offers, "offers")
        match = F.expr(
            f"exists(offers, o -> o.root <> root AND least(n - place, o.left) >= ceil({self.plan.percent} * (n + o.m) / {100 + self.plan.percent}))"
        )
        return known.join(offers, "bucket").where(match).drop("offers")

    def by_leaders(self, members: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
        """Components once every feasible pair of the large buckets ``members`` was compared or needn't be.

        Members that can still match someone in another component are compared: first all with their bucket's leader,
        which then leaves it; after that all with the members outside the bucket's largest component where these are
        few (every open pair has one of them), else with more leaders. Members drop out as they join a component.
        """
        leaders_each, few = 1, self.plan.small
        found = components(links)
        while True:
            open_ = stored(self.open_members(members, found), "open")
            if open_.isEmpty():
                return found
            sizes = open_.groupBy("bucket", "root").agg(F.count("*").alias("size"))
            major = sizes.groupBy("bucket").agg(
                F.max_by("root", F.struct("size", "root")).alias("major"), (F.sum("size") - F.max("size")).alias("minors")
            )
            alive = stored(open_.join(major, "bucket"), "alive")
            part = F.pmod(F.xxhash64("node"), F.lit(leaders_each))
            crowded = alive.where(F.col("minors") > few)
            best = crowded.groupBy("bucket", part.alias("part")).agg(F.min(F.struct("rarity", "node", "n", "place", "root")).alias("lead"))
            leaders = stored(best.select("bucket", "lead.*"), "leaders")
            others = leaders.unionByName(alive.where((F.col("minors") <= few) & (F.col("root") != F.col("major"))).select(leaders.columns))
            others = others.select("bucket", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "place", "root")))
            asked = alive.join(others, "bucket").where("root <> root_b").where(self.feasible("n", "place", "n_b", "place_b"))
            pairs = asked.select(F.greatest("node", "node_b").alias("a"), F.least("node", "node_b").alias("b")).distinct()
            more = stored(self.confirmed(self.near(pairs), sets), "links")
            members = crowded.join(leaders.select("bucket", "node"), ["bucket", "node"], "anti").select(members.columns)
            if not more.isEmpty():
                found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
            leaders_each, few = min(4 * leaders_each, 64), self.plan.few


def _row_keys() -> list:
    """96 bits that tell rows apart by id and text, nulls included."""
    return [F.xxhash64("__id", "__text").alias("k1"), F.hash("__id", "__text").alias("k2")]


def _marked(docs: DataFrame, id_col: str, text_col: str, plan: Plan) -> DataFrame:
    """``id, k1, k2, n, root, component_id`` of every row; the root (of texts with words) names the component."""
    only = docs.select(named(id_col).alias("__id"), named(text_col).cast("string").alias("__text"))
    kind = only.schema["__id"].dataType.simpleString()
    schema = f"id {kind}, k1 long, k2 int, n long, node binary, bands array<long>, sketch binary"
    signed = stored(only.select("*", *_row_keys()).mapInArrow(_sign(plan), schema), "signatures")
    firsts = [F.first(c).alias(c) for c in ("n", "bands", "sketch")]
    reps = stored(signed.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), *firsts), "classes")
    roots = Search(only, reps, plan).links()
    linked = reps.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    label = linked.join(best, "root").select("node", "root", "component_id")
    out = signed.select("id", "k1", "k2", "n", "node").join(label, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "k1", "k2", "n", "root", component.alias("component_id"))


def find_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` of every row.

    Words are runs of bytes other than ASCII white space, A-Z as a-z. A text's set is its distinct ``shingle``-word
    windows, or its whole word sequence if shorter. Sets of ``percent`` similarity or more are linked; ``component_id``
    is the smallest id of a row reachable by links, and a row is kept if that is its own id.

    Null texts and texts without words have the empty set and are linked with nothing. Rows with equal sets are one
    class whether or not they share an id; rows that share an id aren't linked for that. Null ids come last; a component
    of null ids alone keeps its rows. Texts of any length count whole; ties between equally rare shingles go by their hashes
    and don't show in the result. Other columns are ignored; an empty table gives no rows.

    Signatures, sets of candidate classes and link tables are written to the shared folder.
    """
    marked = _marked(docs, id_col, text_col, plan)
    return marked.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs``, all columns, less all but one of each component of ``find_near_duplicates``.

    The row with the smallest id stays (null ids last; rows that share it go by a hash). Texts without words all stay,
    but of rows that repeat id and text one stays.
    """
    marked = _marked(docs, id_col, text_col, plan)
    least = F.min(F.struct(F.col("id").isNull(), "id", "k1", "k2")).alias("least")
    winners = marked.where("root IS NOT NULL").groupBy("root").agg(least).select("least.k1", "least.k2")
    winners = winners.unionByName(marked.where("root IS NULL").select("k1", "k2"))
    columns = docs.columns
    fields = [f"__c{k}" for k in range(len(columns))]
    rows = docs.select(
        *(named(c).alias(f) for c, f in zip(columns, fields, strict=True)),
        named(id_col).alias("__id"),
        named(text_col).cast("string").alias("__text"),
    )
    rows = rows.select(*fields, *_row_keys()).dropDuplicates(["k1", "k2"]).join(winners, ["k1", "k2"], "semi")
    return rows.select(*(F.col(f).alias(c) for c, f in zip(columns, fields, strict=True)))
