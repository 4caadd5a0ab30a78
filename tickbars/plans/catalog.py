"""Every registered query: a function of the session and the data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions import scalars as x
from tickbars.operators import (
    bars,
    bins,
    contracts,
    dims,
    facts,
    gapfill,
    lateness,
    merge,
    normalize,
    quality,
    quotes,
    replay,
    rollups,
    serving,
)
from tickbars.plans import marts
from tickbars.plans.feed import Feed
from tickbars.schemas import BAR_1S
from tickbars.settings import MINUTE_MS, Settings
from tickbars.sinks import messages
from tickbars.sources import events, raw

Query = Callable[[SparkSession, str], DataFrame]

# The moments the reports are taken at, and the parameters of the sample runs.
AS_OF = dt.datetime(2025, 1, 2, 14, 12, 0)
NOW_MS = 1_735_827_130_000
SETTLE_MS = 1_735_825_230_000
ANCHOR_MS = 1_767_225_600_000
UNIVERSE = " wdc, ,msft "
STRICT_LATE_MS = 250
OVERLAP_FIRST_MS = 1_735_824_000_000
OVERLAP_LAST_MS = 1_735_825_800_000
HISTORY_SECONDS = 300

_CATALOG: dict[str, Query] = {}


_PLAIN_TYPES = {
    T.DecimalType: "DOUBLE",
    T.TimestampType: "TIMESTAMP_NTZ",
    T.DateType: "STRING",
    T.IntegerType: "BIGINT",
    T.ShortType: "BIGINT",
}


def _plain(frame: DataFrame) -> DataFrame:
    """Results in types every engine has: doubles for decimals, wall-clock timestamps, dates as text."""
    columns = []
    for field in frame.schema.fields:
        if field.name in (bars.GRAIN, "load_ts"):
            continue
        target = _PLAIN_TYPES.get(type(field.dataType))
        columns.append(f"CAST({field.name} AS {target}) AS {field.name}" if target else field.name)
    return frame.selectExpr(*columns)


def query(build: Callable[[Feed], DataFrame]) -> Callable[[Feed], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(Feed(spark, sf_dir)))

    _CATALOG[build.__name__] = run
    return build


def catalog() -> dict[str, Query]:
    return dict(_CATALOG)


# --- ticks -----------------------------------------------------------------------------------------------


@query
def symbol_universe_filter(feed: Feed) -> DataFrame:
    return normalize.only_symbols(feed.ticks, UNIVERSE).select("arrival_seq", "symbol", "px", "event_ts_ms")


@query
def ticks_normalized(feed: Feed) -> DataFrame:
    return normalize.normalize_ticks(feed.payloads)


@query
def valid_ticks(feed: Feed) -> DataFrame:
    return normalize.valid_ticks(normalize.normalize_ticks(feed.payloads))


@query
def market_open_utc(feed: Feed) -> DataFrame:
    return normalize.market_open_utc(feed.ticks, "13:30:15").select("arrival_seq", "symbol", "px", "event_ts_ms")


@query
def market_open_local(feed: Feed) -> DataFrame:
    opened = normalize.market_open_local(feed.ticks, "America/New_York", "08:45")
    return opened.select("arrival_seq", "symbol", "px", "event_ts_ms")


@query
def rebase_to_anchor(feed: Feed) -> DataFrame:
    return replay.rebase(feed.ticks, ANCHOR_MS).select("arrival_seq", "symbol", "event_ts_ms", "source_event_ts_ms")


@query
def replay_schedule(feed: Feed) -> DataFrame:
    planned = replay.schedule(feed.ticks, speed=2.0, max_sleep_s=0.05, rows_per_chunk=feed.rows_per_chunk)
    return planned.select("arrival_seq", "symbol", "pause_us", "emit_offset_us")


@query
def first_n_rows(feed: Feed) -> DataFrame:
    return replay.first_n(feed.ticks, 1000).select("arrival_seq", "symbol", "px", "sz", "event_ts_ms")


@query
def first_full_week(feed: Feed) -> DataFrame:
    rows = events.read_events(feed.spark, feed.sf_dir)
    return replay.first_full_week(rows, "ts").select("event_id", F.to_date("ts").alias("day"), "value")


@query
def tick_lateness(feed: Feed) -> DataFrame:
    return feed.classified.select("arrival_seq", "symbol", "event_ts_ms", "lateness_ms")


@query
def accepted_ticks(feed: Feed) -> DataFrame:
    return feed.accepted.select("arrival_seq", "symbol", "px", "sz", "event_ts_ms", "lateness_ms")


@query
def late_ticks_dlt(feed: Feed) -> DataFrame:
    letters = lateness.late_tick_letters(feed.classified, feed.settings.max_late_ms)
    return letters.select(
        "reason",
        "lateness_ms",
        "symbol",
        "event_ts_ms",
        F.col("tick.arrival_seq").alias("tick_arrival_seq"),
        F.col("tick.px").alias("tick_px"),
        F.col("tick.sz").alias("tick_sz"),
    )


@query
def late_counts(feed: Feed) -> DataFrame:
    ticks = lateness.late_tick_letters(feed.classified, feed.settings.max_late_ms)
    late_bins = lateness.late_bin_letters(feed.arriving_bins, feed.settings.max_late_ms)
    columns = ["symbol", "reason", "lateness_ms"]
    return lateness.late_counts(ticks.select(*columns).unionByName(late_bins.select(*columns)))


# --- bins ------------------------------------------------------------------------------------------------


@query
def bins_10ms(feed: Feed) -> DataFrame:
    return feed.bins


@query
def bins_deduped(feed: Feed) -> DataFrame:
    """Everything delivered twice, as after a replay from the first offset."""
    return bins.dedupe(feed.bins.unionByName(feed.bins))


@query
def bins_defaulted(feed: Feed) -> DataFrame:
    step = F.expr("start_ts_ms div 10")
    lone = F.col("trade_count") == 1
    thin = feed.bins.select(
        "bin_id",
        F.when(step % 7 != 0, F.col("symbol")).otherwise("").alias("symbol"),
        "start_ts_ms",
        F.when(step % 5 != 0, F.col("end_ts_ms")).alias("end_ts_ms"),
        F.when(step % 11 != 0, F.col("open")).alias("open"),
        *[F.when(~lone, F.col(c)).alias(c) for c in ("high", "low", "close")],
        *[F.when(step % 3 != 0, F.col(c)).alias(c) for c in ("volume", "notional")],
    )
    return bins.with_defaults(thin, feed.settings.bin_ms)


@query
def bin_messages(feed: Feed) -> DataFrame:
    sent = messages.bin_messages(feed.bins)
    return sent.select(
        "key",
        F.get_json_object("value", "$.symbol").alias("symbol"),
        F.get_json_object("value", "$.start_ts_ms").cast("long").alias("start_ts_ms"),
        F.get_json_object("value", "$.close").cast("double").alias("close"),
        F.get_json_object("value", "$.volume").cast("double").alias("volume"),
        F.get_json_object("value", "$.trade_count").cast("long").alias("trade_count"),
        F.get_json_object("value", "$.api_send_ts_ms").cast("long").alias("api_send_ts_ms"),
        F.get_json_object("value", "$.source").alias("source"),
    )


@query
def bin_lateness(feed: Feed) -> DataFrame:
    return feed.arriving_bins.select("bin_id", "symbol", "end_ts_ms", "lateness_ms")


@query
def late_bins_dlt(feed: Feed) -> DataFrame:
    letters = lateness.late_bin_letters(feed.arriving_bins, feed.settings.max_late_ms)
    return letters.select(
        "reason",
        "lateness_ms",
        "symbol",
        "start_ts_ms",
        "end_ts_ms",
        F.col("payload.bin_id").alias("payload_bin_id"),
        F.col("payload.volume").alias("payload_volume"),
    )


@query
def gapfilled_bins(feed: Feed) -> DataFrame:
    return gapfill.filled_summary(feed.bins, MINUTE_MS, feed.settings.bin_ms)


def _dirty_bins(feed: Feed) -> DataFrame:
    """Bins with the faults a broken producer would send."""
    step = F.expr("start_ts_ms div 10")
    return (
        feed.bins.withColumn("bin_id", F.when(step % 17 == 0, F.lower("bin_id")).otherwise(F.col("bin_id")))
        .withColumn("window_ms", F.when(step % 19 == 0, F.lit(20)).otherwise(F.col("window_ms")))
        .withColumn("volume", F.when(step % 23 == 0, -F.col("volume") - 1).otherwise(F.col("volume")))
        .withColumn("trade_count", F.when(step % 29 == 0, F.lit(0)).otherwise(F.col("trade_count")))
        .withColumn("source", F.when(step % 31 == 0, F.lit("other")).otherwise(F.col("source")))
        .withColumn("symbol", F.when(step % 37 == 0, F.lit("")).otherwise(F.col("symbol")))
    )


@query
def bin_contract_violations(feed: Feed) -> DataFrame:
    return contracts.bin_violations(_dirty_bins(feed), feed.settings.bin_ms)


# --- bars ------------------------------------------------------------------------------------------------


@query
def bars_1s(feed: Feed) -> DataFrame:
    return feed.bars


@query
def bars_1s_gapfilled(feed: Feed) -> DataFrame:
    return feed.filled_bars


@query
def bar_messages(feed: Feed) -> DataFrame:
    sent = messages.bar_messages(feed.bars.drop(bars.GRAIN))
    return sent.select(
        "key",
        F.get_json_object("value", "$.symbol").alias("symbol"),
        F.get_json_object("value", "$.start_ts_ms").cast("long").alias("start_ts_ms"),
        F.get_json_object("value", "$.vwap").cast("double").alias("vwap"),
        F.get_json_object("value", "$.bin_count").cast("long").alias("bin_count"),
        F.get_json_object("value", "$.source").alias("source"),
    )


@query
def bars_last_wins(feed: Feed) -> DataFrame:
    """Every bar delivered twice, the second time with a later emission time."""
    first = feed.bars.drop(bars.GRAIN).withColumn("arrival_seq", F.col("start_ts_ms") * 2)
    again = first.withColumn("ingest_ts_ms", F.col("ingest_ts_ms") + 1000).withColumn(
        "arrival_seq", F.col("arrival_seq") + 1
    )
    kept = bars.last_per_key(first.unionByName(again), "bar_id", "arrival_seq")
    return kept.select("bar_id", "symbol", "start_ts_ms", "close", "volume", "vwap", "ingest_ts_ms", "arrival_seq")


@query
def expected_bars_1s(feed: Feed) -> DataFrame:
    step = F.expr("start_ts_ms div 10")
    log = feed.bins.withColumn("notional", F.when(step % 3 != 0, F.col("notional"))).withColumn(
        "high", F.when(step % 5 != 0, F.col("high"))
    )
    return bars.expected_bars(log)


@query
def fact_1s_typed(feed: Feed) -> DataFrame:
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in BAR_1S.fields])
    second = F.expr("start_ts_ms div 1000")
    thin = (
        feed.bars.drop(bars.GRAIN)
        .withColumn("vwap", F.when(second % 5 != 0, F.col("vwap")))
        .withColumn("bin_count", F.when(second % 7 != 0, F.col("bin_count")))
        .withColumn("end_ts_ms", F.when(second % 11 != 0, F.col("end_ts_ms")).otherwise(0))
        .withColumn("ingest_ts_ms", F.when(second % 13 != 0, F.col("ingest_ts_ms")))
    )
    records = messages.bar_messages(thin).select(F.from_json("value", loose).alias("r")).select("r.*")
    return facts.fact_1s_from_records(records, F.lit(NOW_MS).cast("long"), feed.load_ts)


@query
def fact_1s_rejects(feed: Feed) -> DataFrame:
    """Bars whose volume outgrew the fact table's decimals."""
    huge = F.expr("CASE WHEN (start_ts_ms div 1000) % 7 = 0 THEN CAST(volume + 1000000000000 AS DECIMAL(38,6)) ELSE volume END")
    lost = facts.rejects(feed.bars.withColumn("volume", huge))
    return lost.select("bar_id", "symbol", "start_ts_ms", F.array_join("misfits", ",").alias("misfits"))


@query
def bars_defaulted(feed: Feed) -> DataFrame:
    second = F.expr("start_ts_ms div 1000")
    thin = feed.bars.select(
        "bar_id",
        F.when(second % 7 != 0, F.col("symbol")).alias("symbol"),
        F.when(second % 11 != 0, F.col("start_ts_ms")).otherwise(0).alias("start_ts_ms"),
        F.when(second % 5 != 0, F.col("open")).alias("open"),
        F.when(second % 3 != 0, F.col("high")).alias("high"),
        F.when(second % 3 != 0, F.col("low")).alias("low"),
        "close",
        "volume",
        F.when(second % 2 != 0, F.col("notional")).alias("notional"),
        F.when(second % 13 != 0, F.col("ingest_ts_ms")).alias("ingest_ts_ms"),
    )
    return rollups.with_defaults(thin, F.lit(NOW_MS).cast("long"))


@query
def bar_contract_violations(feed: Feed) -> DataFrame:
    second = F.expr("start_ts_ms div 1000")
    dirty = (
        feed.bars.withColumn("bar_id", F.when(second % 17 == 0, F.lower("bar_id")).otherwise(F.col("bar_id")))
        .withColumn("notional", F.when(second % 19 == 0, -F.col("notional") - 1).otherwise(F.col("notional")))
        .withColumn("vwap", F.when(second % 23 != 0, F.col("vwap")))
        .withColumn("source", F.when(second % 29 == 0, F.lit("replay")).otherwise(F.col("source")))
    )
    return contracts.bar_violations(dirty)


# --- rollups and facts -----------------------------------------------------------------------------------


@query
def bars_60s(feed: Feed) -> DataFrame:
    return feed.minutes


@query
def minute_index(feed: Feed) -> DataFrame:
    indexed = rollups.minute_index(feed.minutes.drop(bars.GRAIN), feed.settings.flush_minutes)
    return indexed.select("bar_id", "symbol", "start_ts_ms", "minute_index")


@query
def settled_minutes(feed: Feed) -> DataFrame:
    return rollups.settled_minutes(feed.minutes, SETTLE_MS)


@query
def bars_300s_count(feed: Feed) -> DataFrame:
    return feed.counted


@query
def bars_300s_aligned(feed: Feed) -> DataFrame:
    return feed.aligned


def _two_batches(rows: DataFrame) -> DataFrame:
    """A first load, then a second one that repeats its tail with a later emission time and goes on to the end."""
    first = rows.where(F.col("start_ts_ms") < OVERLAP_LAST_MS)
    second = rows.where(F.col("start_ts_ms") >= OVERLAP_FIRST_MS).withColumn(
        "ingest_ts_ms", F.col("ingest_ts_ms") + 5000
    )
    return merge.merge_by_key(first, second)


@query
def upsert_1s(feed: Feed) -> DataFrame:
    return facts.fact_1s(_two_batches(feed.bars.drop(bars.GRAIN)), feed.load_ts)


@query
def upsert_60s(feed: Feed) -> DataFrame:
    indexed = rollups.minute_index(feed.minutes.drop(bars.GRAIN), feed.settings.flush_minutes)
    return facts.fact_60s(_two_batches(indexed), feed.load_ts)


@query
def upsert_300s(feed: Feed) -> DataFrame:
    return facts.fact_300s(_two_batches(feed.counted), feed.load_ts)


# --- dimensions ------------------------------------------------------------------------------------------


@query
def dim_symbol(feed: Feed) -> DataFrame:
    """The traded symbols with their dimension rows, and how often each traded."""
    traded = feed.ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("ticks"))
    return dims.with_symbol_details(traded, dims.dim_symbol(feed.spark, feed.load_ts).drop("load_ts"))


@query
def dim_calendar(feed: Feed) -> DataFrame:
    """The calendar of the days the events span."""
    return dims.calendar_of(events.read_events(feed.spark, feed.sf_dir), "ts", feed.load_ts)


@query
def bars_with_session(feed: Feed) -> DataFrame:
    calendar = dims.dim_calendar(feed.spark, load_ts=feed.load_ts)
    joined = dims.with_session(feed.facts_60s, calendar)
    return joined.select("bar_id", "symbol", "start_ts", "volume", "is_trading_session", "session_name")


# --- marts -----------------------------------------------------------------------------------------------


@query
def vw_price_60s(feed: Feed) -> DataFrame:
    return marts.price_60s(feed.facts_60s, dims.dim_symbol(feed.spark, feed.load_ts))


@query
def vw_pipeline_5m(feed: Feed) -> DataFrame:
    return marts.pipeline_5m(feed.facts_300s)


@query
def vw_pipeline_minute_metrics(feed: Feed) -> DataFrame:
    return marts.pipeline_minute_metrics(feed.facts_60s)


@query
def vw_session_vwap(feed: Feed) -> DataFrame:
    return marts.session_vwap(feed.facts_60s)


@query
def vw_top_movers_15m(feed: Feed) -> DataFrame:
    return marts.top_movers(feed.facts_300s, AS_OF)


@query
def vw_volatility_bands(feed: Feed) -> DataFrame:
    return _rounded(marts.volatility_bands(feed.facts_60s), "ma_60", "std_60")


@query
def vw_price_60s_features(feed: Feed) -> DataFrame:
    return _rounded(marts.price_60s_features(feed.facts_60s), "ma_60", "std_60", "rolling_vwap")


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(*[x.round6(F.col(c)).alias(c) if c in names else F.col(c) for c in rows.columns])


# --- quality ---------------------------------------------------------------------------------------------


def _two_runs(feed: Feed) -> tuple[DataFrame, DataFrame]:
    """Bars rebuilt from the bins, and the bars of a run with a stricter lateness bound."""
    strict = Feed(feed.spark, feed.sf_dir, Settings(max_late_ms=STRICT_LATE_MS))
    return bars.expected_bars(feed.bins), strict.bars


@query
def reconcile_bars(feed: Feed) -> DataFrame:
    return quality.reconcile(*_two_runs(feed))


@query
def reconcile_examples(feed: Feed) -> DataFrame:
    return quality.all_examples(quality.reconcile(*_two_runs(feed)))


@query
def validation_summary(feed: Feed) -> DataFrame:
    return quality.summary(*_two_runs(feed))


@query
def latency_stats(feed: Feed) -> DataFrame:
    return quality.latency_stats(feed.bars)


# --- serving ---------------------------------------------------------------------------------------------


@query
def serving_bars(feed: Feed) -> DataFrame:
    second = F.expr("start_ts_ms div 1000")
    thin = (
        feed.received_bars.withColumn("end_ts_ms", F.when(second % 5 != 0, F.col("end_ts_ms")))
        .withColumn("vwap", F.when(second % 7 != 0, F.col("vwap")))
        .withColumn("ingest_ts_ms", F.when(second % 11 != 0, F.col("ingest_ts_ms")))
        .withColumn("source", F.when(second % 13 != 0, F.col("source")))
    )
    return serving.serving_bars(thin)


@query
def latest_n_bars(feed: Feed) -> DataFrame:
    return serving.latest_n(feed.bars, feed.settings.bars_per_symbol)


@query
def latest_bar_detail(feed: Feed) -> DataFrame:
    newest = serving.latest_bar(feed.bars)
    received = newest.withColumn("received_ts_ms", F.col("ingest_ts_ms") + 30)
    return serving.bar_detail(received)


@query
def bars_last_n_seconds(feed: Feed) -> DataFrame:
    recent = serving.last_seconds(feed.bars, HISTORY_SECONDS)
    return recent.select("bar_id", "symbol", "start_ts_ms", "close", "volume").orderBy("symbol", "start_ts_ms")


@query
def distinct_symbols(feed: Feed) -> DataFrame:
    return serving.distinct_symbols(feed.bars)


@query
def avg_real_gap(feed: Feed) -> DataFrame:
    return serving.average_real_gap(serving.last_seconds(feed.bars, HISTORY_SECONDS))


@query
def gap_metrics(feed: Feed) -> DataFrame:
    return serving.gap_metrics(
        feed.received_bars,
        NOW_MS,
        ("received_ts_ms", "symbol", "start_ts_ms"),
        feed.settings.metrics_window,
        feed.settings.bars_per_symbol,
    )


@query
def live_tick_rows(feed: Feed) -> DataFrame:
    return serving.live_rows(feed.ticks)


@query
def live_tick_series(feed: Feed) -> DataFrame:
    return serving.live_series(feed.ticks)


@query
def live_tick_stats(feed: Feed) -> DataFrame:
    return serving.live_stats(feed.ticks)


@query
def duration_text(feed: Feed) -> DataFrame:
    received = F.col("received_ts_ms")
    api = F.when(F.col("api_send_ts_ms").isNotNull(), received - F.col("api_send_ts_ms"))
    return feed.received_bars.select(
        "bar_id",
        x.duration_text(api).alias("api_gap"),
        x.duration_text(received - F.col("ingest_ts_ms")).alias("producer_gap"),
    )


# --- quotes and raw landing ------------------------------------------------------------------------------


@query
def quote_normalize(feed: Feed) -> DataFrame:
    return quotes.normalize_quotes(feed.quotes)


@query
def quote_backfill_asof(feed: Feed) -> DataFrame:
    return quotes.backfill(quotes.normalize_quotes(feed.quotes), feed.minutes)


@query
def quotes_append(feed: Feed) -> DataFrame:
    priced = feed.quotes.where(F.col("last_price").isNotNull()).select(
        "symbol", F.col("last_price").alias("px"), (F.col("quote_ts_ms") / F.lit(1000.0)).alias("event_ts")
    )
    return quotes.quote_rows(priced)


@query
def raw_json_fields(feed: Feed) -> DataFrame:
    rows = events.read_events(feed.spark, feed.sf_dir)
    line = F.concat(
        F.lit('{"id":'),
        F.col("event_id").cast("string"),
        F.lit(',"type":"'),
        F.col("event_type"),
        F.lit('","props":'),
        F.col("props"),
        F.lit("}"),
    )
    landed = raw.land(rows.select(line.alias("value")), load_ts=feed.load_ts)
    return landed.select(
        raw.field("$.id", "bigint").alias("id"),
        raw.field("$.type", "string").alias("type"),
        raw.field("$.props.k", "bigint").alias("k"),
        raw.field("$.props.absent", "string").alias("absent"),
        "load_ts",
    )


