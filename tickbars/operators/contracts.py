"""Check bins and bars against their record contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions.scalars import ID_PATTERN
from tickbars.settings import BIN_MS

# What the two contracts demand of a record.
BIN_REQUIRED = [
    "bin_id",
    "symbol",
    "start_ts_ms",
    "end_ts_ms",
    "window_ms",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "notional",
    "trade_count",
    "api_send_ts_ms",
    "ingest_ts_ms",
]
BAR_REQUIRED = [
    "bar_id",
    "symbol",
    "start_ts_ms",
    "end_ts_ms",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "notional",
    "vwap",
    "bin_count",
    "api_send_ts_ms",
    "ingest_ts_ms",
]
BIN_MINIMUM = {
    "start_ts_ms": 0,
    "end_ts_ms": 0,
    "volume": 0,
    "notional": 0,
    "trade_count": 1,
    "max_lateness_ms": 0,
    "api_send_ts_ms": 0,
    "source_event_ts_ms": 0,
    "ingest_ts_ms": 0,
}
BAR_MINIMUM = {
    "start_ts_ms": 0,
    "end_ts_ms": 0,
    "volume": 0,
    "notional": 0,
    "bin_count": 0,
    "max_lateness_ms": 0,
    "api_send_ts_ms": 0,
    "source_event_ts_ms": 0,
    "ingest_ts_ms": 0,
}
BIN_SOURCES = ["replay"]
BAR_SOURCES = ["aggregator"]


def _rules(
    id_field: str, required: list[str], minimum: dict[str, int], sources: list[str], window_ms: int | None
) -> list[tuple[str, Column]]:
    """Named conditions that are true when a record breaks the rule. A null optional field counts as absent."""
    rules = [(f"{name}:required", F.col(name).isNull()) for name in required]
    rules.append((f"{id_field}:pattern", ~F.col(id_field).rlike(ID_PATTERN)))
    rules.append(("symbol:min_length", F.length("symbol") < 1))
    rules += [(f"{name}:minimum", F.col(name) < low) for name, low in minimum.items()]
    if window_ms is not None:
        rules.append(("window_ms:const", F.col("window_ms") != window_ms))
    rules.append(("source:enum", ~F.col("source").isin(sources)))
    return rules


def bin_rules(window_ms: int = BIN_MS, fillers: bool = False) -> list[tuple[str, Column]]:
    """Rules for bins. With ``fillers`` the rules a zero-trade filler bin cannot meet do not apply to one."""
    rules = _rules("bin_id", BIN_REQUIRED, BIN_MINIMUM, BIN_SOURCES, window_ms)
    if not fillers:
        return rules
    real = F.col("trade_count") > 0
    excused = {"trade_count:minimum", "api_send_ts_ms:required"}
    return [(name, broken & real if name in excused else broken) for name, broken in rules]


def bar_rules() -> list[tuple[str, Column]]:
    return _rules("bar_id", BAR_REQUIRED, BAR_MINIMUM, BAR_SOURCES, None)


def violations(rows: DataFrame, id_field: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per record and broken rule."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]), lambda rule: rule.isNotNull())
    return rows.select(id_field, "symbol", "start_ts_ms", F.explode(broken).alias("rule"))


def split_valid(rows: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Records that keep all rules, and the others."""
    bad = F.lit(False)
    for _, broken in rules:
        bad = bad | F.coalesce(broken, F.lit(False))
    return rows.where(~bad), rows.where(bad)


def bin_violations(bins: DataFrame, window_ms: int = BIN_MS, fillers: bool = False) -> DataFrame:
    return violations(bins, "bin_id", bin_rules(window_ms, fillers))


def bar_violations(bars: DataFrame) -> DataFrame:
    return violations(bars, "bar_id", bar_rules())
