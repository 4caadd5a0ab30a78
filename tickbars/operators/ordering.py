"""Ordered work per symbol that no single hot symbol can stall.

A window over ``PARTITION BY symbol`` puts the whole history of a symbol into one task. Here the order
axis is cut into chunks, windows run inside ``(symbol, chunk)``, and what must cross a border is carried
over from a summary with one row per symbol and chunk. Two kinds of chunk are used:

* time chunks, for series that hold one row per symbol and grid step (bins, bars): the row count of a
  chunk is bounded by the grid itself;
* even chunks, for raw ticks, where any stretch of time may be crowded: equally deep stretches of a unique order
  column, as many as the rows need. File sources number their rows without gaps, so a division gives the chunk; for
  other columns the borders are found by the same plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 1_000_000
CHUNK = "_chunk"


#: Stretches of equal row counts that any order column is cut into first; a power of two.
STRETCHES = 1_024


def dense_chunk(order: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> Column:
    """Chunk number of rows that are numbered without gaps, as ``dense_numbers`` and the sources do: nothing is looked up."""
    return F.floor(F.col(order) / F.lit(rows_per_chunk)).cast("long")


def with_even_chunk(rows: DataFrame, order: str, rows_per_chunk: int = ROWS_PER_CHUNK, name: str = CHUNK) -> DataFrame:
    """Add a chunk number for any integral order column, however it leaps: about ``rows_per_chunk`` rows to a chunk.

    A scalar subquery of the same plan counts the rows and finds the borders of equally deep stretches (a mergeable
    quantile sketch of fixed size); a row finds its stretch by bisection. Small tables join neighbouring stretches to a
    chunk, large ones cut each stretch evenly. Borders only deal the work: whatever they are, the chunk number never falls
    along ``order``. One plan at every size.
    """
    shares = [k / STRETCHES for k in range(1, STRETCHES)]
    place = F.col(order).cast("long")
    bounds = F.struct(
        F.min(place).alias("low"),
        F.max(place).alias("high"),
        F.count(place).alias("n"),
        F.percentile_approx(place, shares, 20 * STRETCHES).alias("borders"),
    )
    marked = rows.withColumn("_bounds", rows.agg(bounds.alias("bounds")).scalar())
    found = F.col("_bounds")
    borders = found.getField("borders")
    steps = F.array(*[F.lit(STRETCHES >> k) for k in range(1, STRETCHES.bit_length())])
    # Borders 1 .. STRETCHES-1 are ascending; each step halves what is left of them.
    stretch = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(place >= F.element_at(borders, at + step), at + step).otherwise(at)
    )
    chunks = F.greatest(F.ceil(found.getField("n") / F.lit(rows_per_chunk)), F.lit(1))
    whole = F.floor(stretch * chunks / F.lit(STRETCHES))
    # Fewer rows than a stretch each: the sketch's borders are exact enough. More: cut between two borders.
    parts = F.greatest(F.ceil(chunks / F.lit(STRETCHES)), F.lit(1))
    start = F.when(stretch == 0, found.getField("low")).otherwise(F.element_at(borders, F.greatest(stretch, F.lit(1))))
    end = F.when(stretch == STRETCHES - 1, found.getField("high") + 1).otherwise(
        F.element_at(borders, F.least(stretch + 1, F.lit(STRETCHES - 1)))
    )
    inside = F.floor((place - start).cast("double") / F.greatest((end - start).cast("double"), F.lit(1.0)) * parts)
    fine = stretch * parts + F.least(F.greatest(inside, F.lit(0)), parts - 1)
    return marked.withColumn(name, F.when(parts > 1, fine).otherwise(whole).cast("long")).drop("_bounds")


def dense_numbers(rows: DataFrame, groups: Sequence[Sequence[str]], line: str, name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... by place and, within a place, by ``line``, which has no gaps there.

    A place is given by levels of columns, say file and block: its row count and first line are aggregated on the map side,
    then the counts are summed up level by level, each level within the one above it. So the windows see a row per place,
    never the rows, and only the top level (a row per file) is ordered as a whole.
    """
    columns = [c for level in groups for c in level]
    counts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), F.min(line).alias("_first_line"))
    offsets = F.lit(0)
    above: list[str] = []
    for depth, level in enumerate(groups):
        if depth + 1 < len(groups):
            sums = counts.groupBy(*above, *level).agg(F.sum("_n").alias("_n"))
        else:
            sums = counts
        over = W.partitionBy(*(above or [F.lit(0)])).orderBy(*level).rowsBetween(W.unboundedPreceding, -1)
        before = f"_before_{depth}"
        summed = sums.select(*above, *level, F.coalesce(F.sum("_n").over(over), F.lit(0)).alias(before))
        above = [*above, *level]
        counts = counts.join(summed, above)
        offsets = offsets + F.col(before)
    placed = rows.join(counts.select(*columns, (offsets - F.col("_first_line")).alias("_shift")), columns)
    return placed.withColumn(name, F.col("_shift") + F.col(line)).drop("_shift")


def carry(
    rows: DataFrame,
    keys: Sequence[str],
    chunk: str,
    summary: Sequence[Column],
    carried: Callable[[WindowSpec], Sequence[Column]],
) -> DataFrame:
    """Join to every row what the other chunks of its key hand over.

    ``summary`` aggregates one chunk; ``carried`` builds the columns to hand over from the per-key window
    over the chunk summaries. The summary is pre-aggregated on the map side and has one row per key and
    chunk, whatever the number of rows in it.
    """
    chunks = rows.groupBy(*keys, chunk).agg(*summary)
    over = W.partitionBy(*keys).orderBy(chunk)
    handed = chunks.select(*keys, chunk, *carried(over))
    return rows.join(handed, [*keys, chunk], "left")


def with_ordinal(rows: DataFrame, keys: Sequence[str], chunk: Column, order: str, name: str) -> DataFrame:
    """Number the rows of each key from 1 in order, counting whole chunks instead of sorting a key at once.

    ``chunk`` must not decrease along ``order`` within a key.
    """
    marked = rows.withColumn(CHUNK, chunk)
    before = carry(
        marked,
        keys,
        CHUNK,
        [F.count(F.lit(1)).alias("_n")],
        lambda over: [
            F.coalesce(F.sum("_n").over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before")
        ],
    )
    inside = W.partitionBy(*keys, CHUNK).orderBy(order)
    numbered = before.withColumn(name, F.col("_before") + F.row_number().over(inside))
    return numbered.drop(CHUNK, "_before")


def rolling_sums(
    rows: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    length: int,
    sums: dict[str, Column],
    block: int = 50_000,
) -> DataFrame:
    """Sums over the last ``length`` rows of each key, without one task per key.

    Rows are cut into blocks of ``block`` ordinals; the last ``length - 1`` rows of a block are copied ahead of
    the next one, so each block finds its whole window at home, and the copies are dropped afterwards. A window
    sum is the difference of two running sums, one addition per row whatever the length; pass exact numbers
    (integers, decimals), for which that difference is exact too.
    """
    if block < length:
        raise ValueError("block must be at least the window length")
    position = F.pmod(F.col(ordinal) - 1, F.lit(block).cast("long"))
    home = F.expr(f"({ordinal} - 1) div {block}")
    homes = F.when(position >= block - (length - 1), F.array(home, home + 1)).otherwise(F.array(home))
    spread = rows.withColumn("_home", home).withColumn("_block", F.explode(homes))
    over = W.partitionBy(*keys, "_block").orderBy(ordinal)
    running = over.rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = spread.select("*", *[F.sum(value).over(running).alias(f"_run_{name}") for name, value in sums.items()])
    windows = [
        (F.col(f"_run_{name}") - F.coalesce(F.lag(f"_run_{name}", length).over(over), F.lit(0))).alias(name)
        for name in sums
    ]
    out = runs.select(*rows.columns, "_home", "_block", *windows)
    return out.where(F.col("_home") == F.col("_block")).drop("_home", "_block")


def top_per_key(rows: DataFrame, keys: Sequence[str], chunk: Column, order: Column, count: int) -> DataFrame:
    """The first ``count`` rows of each key: first within each chunk of a key, then among the survivors."""
    local = W.partitionBy(*keys, CHUNK).orderBy(order)
    final = W.partitionBy(*keys).orderBy(order)
    return (
        rows.withColumn(CHUNK, chunk)
        .withColumn("_rank", F.row_number().over(local))
        .where(F.col("_rank") <= count)
        .withColumn("_rank", F.row_number().over(final))
        .where(F.col("_rank") <= count)
        .drop("_rank", CHUNK)
    )
