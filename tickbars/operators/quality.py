"""Reconcile bars against rebuilt ones, and measure latency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickbars.functions import scalars as x
from tickbars.settings import TOLERANCE

# The fields compared, the quantile reported and the examples shown.
COMPARED = ["open", "high", "low", "close", "volume", "notional", "vwap", "bin_count"]
QUANTILE = 0.95
EXAMPLES = 5

MISSING = "missing"
EXTRA = "extra"
MISMATCH = "mismatch"

#: Bits of a digit of the quantile search; four digits make a number.
DIGIT_BITS = 16


def _paired(expected: DataFrame, actual: DataFrame) -> DataFrame:
    def side(frame: DataFrame, name: str) -> DataFrame:
        values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in COMPARED]
        return frame.select("bar_id", F.struct(*values).alias(name))

    return side(expected, "expected").join(side(actual, "actual"), "bar_id", "full_outer")


def _differs(field: str, tolerance: float) -> Column:
    return ~x.within(F.col(f"expected.{field}"), F.col(f"actual.{field}"), tolerance)


def reconcile(expected: DataFrame, actual: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Every difference between two bar tables: missing bars, extra bars and fields further apart than allowed.

    Both sides must hold one row per ``bar_id`` (see ``bars.last_per_key``), so the full outer join cannot multiply.
    """

    def finding(kind: str, field: Column, a: Column, b: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), field.alias("field"), a.alias("expected"), b.alias("actual"))

    nothing, no_field = F.lit(None).cast("double"), F.lit(None).cast("string")
    missing = F.when(F.col("actual").isNull(), finding(MISSING, no_field, nothing, nothing))
    extra = F.when(F.col("expected").isNull(), finding(EXTRA, no_field, nothing, nothing))
    fields = [
        F.when(
            _differs(name, tolerance),
            finding(MISMATCH, F.lit(name), F.col(f"expected.{name}"), F.col(f"actual.{name}")),
        )
        for name in COMPARED
    ]
    findings = F.filter(F.array(missing, extra, *fields), lambda f: f.isNotNull())
    return _paired(expected, actual).select("bar_id", F.inline(findings))


def examples(findings: DataFrame, kind: str, count: int = EXAMPLES) -> DataFrame:
    """The first few findings of one kind, for a report."""
    return findings.where(F.col("kind") == kind).orderBy("bar_id", "field").limit(count)


def all_examples(findings: DataFrame, count: int = EXAMPLES) -> DataFrame:
    """The first few findings of each kind."""
    parts = [examples(findings, kind, count) for kind in (MISSING, EXTRA, MISMATCH)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def summary(expected: DataFrame, actual: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Counts of bars and differences, and whether the run passes, in one pass over the joined tables."""
    both = F.col("expected").isNotNull() & F.col("actual").isNotNull()
    diffs = sum((F.when(both & _differs(name, tolerance), 1).otherwise(0) for name in COMPARED), F.lit(0))
    counted = _paired(expected, actual).agg(
        F.count("expected").alias("expected_bars"),
        F.count("actual").alias("actual_bars"),
        F.count_if(F.col("actual").isNull()).alias("missing_bars"),
        F.count_if(F.col("expected").isNull()).alias("extra_bars"),
        F.coalesce(F.sum(diffs), F.lit(0)).cast("long").alias("field_diffs"),
    )
    clean = (F.col("missing_bars") == 0) & (F.col("extra_bars") == 0) & (F.col("field_diffs") == 0)
    return counted.withColumn("passed", clean)


def _digit_pass(counts: DataFrame, shift: int, state: DataFrame) -> DataFrame:
    """Narrow ``state``, one row with the ``prefix`` of the value sought and its ``rank`` among the values with that prefix, by
    one digit. A digit has ``1 << DIGIT_BITS`` values, and as many counts are all that one task orders.
    """
    above = F.shiftright("latency", min(shift + DIGIT_BITS, 63))
    carried = ["rank", "total", "worst"]
    rows = counts.select("latency", "n", above.alias("prefix")).join(state, "prefix")
    firsts = [F.first(c).alias(c) for c in carried]
    digits = rows.groupBy(F.shiftright("latency", shift).alias("prefix")).agg(F.sum("n").alias("n"), *firsts)
    upto = W.partitionBy(F.lit(1)).orderBy("prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = digits.withColumn("rank", F.col("rank") - F.sum("n").over(upto) + F.col("n"))
    return placed.where("rank >= 0 AND rank < n").select("prefix", *carried)


def latency_stats(bars: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Count, nearest-rank quantile and maximum of the emission latency; zeros for an empty table.

    The rank is ``min(n-1, floor(q*n))`` counted from 0. Values are selected digit by digit, highest digit first: equal
    values are counted on the map side, and each pass sums the counts by one digit among the values that agree in the
    digits found before. So however far the values spread, no task orders more than a fixed number of counts.
    """
    ingest = F.coalesce("ingest_ts_ms", "end_ts_ms")
    counts = (
        bars.select(x.at_least_zero(F.coalesce(ingest - F.col("end_ts_ms"), F.lit(0).cast("long"))).alias("latency"))
        .groupBy("latency")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    overall = counts.agg(F.sum("n").alias("total"), F.max("latency").alias("worst"))
    rank = F.least(F.col("total") - 1, F.floor(F.col("total") * F.lit(quantile))).cast("long")
    # No latency is below 0, so all start with the prefix 0; as a literal it would make the first join a nested loop.
    state = overall.select(F.shiftright("worst", 63).alias("prefix"), rank.alias("rank"), "total", "worst")
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        state = _digit_pass(counts, shift, state)
    zero = F.lit(0).cast("long")
    return state.agg(
        F.coalesce(F.max("total"), zero).alias("bars"),
        F.coalesce(F.max("prefix"), zero).alias("p95_ms"),
        F.coalesce(F.max("worst"), zero).alias("max_ms"),
    )
