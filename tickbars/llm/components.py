"""Connected components of a link table: local forests, then alternating stars.

Every task first replaces its links, ``BLOCK`` at a time, by stars on the smallest nodes that they connect, so repeated
links and most of a group go before anything is shuffled. A table that fits one block is settled by that. In a larger one
each pass hangs every node's larger neighbours, then its smaller ones, on the smallest node among them. Degrees never
matter to one task: minima are aggregated before the shuffle and the join back can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import column_of, stored

#: Links that a task holds at once.
BLOCK = 100_000


def star_links(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(node, smallest node that the links connect it with) of every node but the smallest ones."""
    ends = pa.concat_arrays([a, b])
    nodes = pc.unique(ends)
    nodes = nodes.take(pc.sort_indices(nodes))
    at = pc.index_in(ends, value_set=nodes).to_numpy(zero_copy_only=False)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while (root[x] != root[y]).any():
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes.take(pa.array(hung)), nodes.take(pa.array(root[hung]))


def _forests(block: int):
    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sides = (pa.concat_arrays([column_of(x, c) for x in held]) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([*star_links(*sides)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= block:
                joined = solve(held)
                # What is still large goes on; else the next links may connect it further.
                if joined.num_rows >= block // 2:
                    yield joined
                    joined = joined.slice(0, 0)
                held = [joined]
        if held:
            yield solve(held)

    return run


def components(links: DataFrame, block: int = BLOCK) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the root is the component's smallest node.

    Loops and repeated links don't matter; a link with a null end is left out; no links give no rows.
    """
    schema = ", ".join(f"{c} {links.schema[c].dataType.simpleString()}" for c in ("a", "b"))
    edges = stored(links.where("a <> b").select("a", "b").mapInArrow(_forests(block), schema), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        fits = 0 < now[0] <= block
        if fits:
            edges = stored(edges.coalesce(1).mapInArrow(_forests(block + 1), schema), "edges")
        if fits or now[0] == 0 or tuple(now) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = tuple(now)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(down.withColumnRenamed("m", "b")).where("a <> b").distinct(), "edges")
