"""Texts of a few rows of a large table, without moving the others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import column_of

#: Bits of the bitmap of ids (2 MB). Ids that share a bit with one asked for are moved as well, and dropped by the join.
CELLS = 1 << 24


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            cell = column_of(batch, "__cell").to_numpy(zero_copy_only=False).astype(np.uint64)
            hit = (words[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1)
            if hit.any():
                yield batch.select(["__id", "__text"]).filter(pa.array(hit.astype(bool)))

    return run


def texts_by_id(only: DataFrame, wanted: DataFrame, cells: int = CELLS) -> DataFrame:
    """``__text`` beside the columns of ``wanted`` for every row of ``only`` whose ``__id`` is a ``rep`` there, null ids too.

    Only rows that a bitmap of the ids lets through are shuffled. ``wanted`` is read twice, so it should be stored.
    """
    bits = wanted.select(F.pmod(F.xxhash64("rep"), F.lit(cells)).alias("cell"))
    bits = bits.selectExpr("shiftright(cell, 6) AS word", "shiftleft(1L, CAST(cell % 64 AS INT)) AS bit")
    words = np.zeros(-(-cells // 64), np.int64)
    for row in bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():  # as many rows as words at most
        words[row.word] = row.bits
    shared = only.sparkSession.sparkContext.broadcast(words.view(np.uint64))
    marked = only.select("__id", "__text", F.pmod(F.xxhash64("__id"), F.lit(cells)).alias("__cell"))
    kind = only.schema["__id"].dataType.simpleString()
    few = marked.mapInArrow(_hits(shared), f"__id {kind}, __text string")
    # Shuffled even if ``wanted`` is small: else a task would run this step and the caller's at once, with two Python workers.
    return few.join(wanted.hint("merge"), F.col("__id").eqNullSafe(F.col("rep"))).drop("__id", "rep")
