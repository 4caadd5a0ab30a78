"""Texts of wanted rows against a plain join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickbars.llm import lookup


@pytest.mark.parametrize("cells", [64, 1000, lookup.CELLS])
def test_texts_by_id(spark, cells):
    rows = [(i, f"text {i}") for i in range(500)] + [(7, "again"), (None, "lone"), (8, None)]
    only = spark.createDataFrame(rows, "__id long, __text string")
    wanted = spark.createDataFrame([(7, b"x"), (8, b"y"), (None, b"z"), (9999, b"-")], "rep long, node binary")
    got = lookup.texts_by_id(only, wanted, cells).select("__text", F.decode("node", "utf-8").alias("node")).collect()
    expected = [("text 7", "x"), ("again", "x"), ("text 8", "y"), (None, "y"), ("lone", "z")]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert lookup.texts_by_id(only, wanted.limit(0), cells).count() == 0


def test_other_rows_stay_where_they_are():
    """Of 10,000 rows only the three asked for go on, to be shuffled."""
    words = np.zeros(lookup.CELLS // 64, np.uint64)
    cells = np.arange(10_000) * 1_601
    for c in cells[[0, 77, 9_999]].tolist():
        words[c >> 6] |= np.uint64(1 << (c & 63))
    shared = type("Shared", (), {"value": words})
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(["t"] * 10_000), pa.array(cells)], names=["__id", "__text", "__cell"])
    assert [x.column(0).to_pylist() for x in lookup._hits(shared)(iter([batch]))] == [[0, 77, 9_999]]


def test_a_small_table_of_ids_chains_no_two_python_steps(spark):
    """With a broadcast join the caller's step would run in the same tasks as the look-up, each with two Python workers."""
    only = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "__id LONG, __text STRING")
    wanted = spark.sql("SELECT * FROM VALUES (1L, 'x'), (NULL, 'z') AS t(rep, node)")  # of known size, as a stored table is
    found = lookup.texts_by_id(only, wanted).mapInArrow(lambda batches: batches, "__text STRING, node STRING")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2
    above, between, _ = plan.split("MapInArrow")
    assert "Exchange hashpartitioning" in between and "BroadcastExchange" not in plan
    assert sorted(map(tuple, found.collect())) == [("a", "x"), ("c", "z")]
