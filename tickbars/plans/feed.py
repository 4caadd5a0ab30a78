"""The pipeline over the given tables: from events to ticks, bins, bars, rollups and facts."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators import bars, bins, facts, gapfill, lateness, ordering, rollups
from tickbars.session import prepare
from tickbars.settings import Settings
from tickbars.sources import events

# Emission and receipt times that follow from the data, so that results repeat.
LOAD_TS = dt.datetime(2025, 1, 2, 15, 0, 0)


def emitted_ms() -> Column:
    """A bin's or bar's emission time: half a second after its end, plus a little that varies."""
    return F.expr("end_ts_ms + 500 + (start_ts_ms div 10) % 200")


def with_receipt(rows: DataFrame) -> DataFrame:
    """Add when a bar reached the broker (sometimes unknown) and when it reached the reader."""
    second = F.expr("start_ts_ms div 1000")
    return rows.withColumn("received_ts_ms", F.col("ingest_ts_ms") + 30 + second % 90).withColumn(
        "record_ts_ms", F.when(second % 13 != 0, F.col("ingest_ts_ms") + 5 + second % 20)
    )


class Feed:
    """Lazily built frames over one data folder. Nothing runs until a result is read."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        settings: Settings | None = None,
        rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
    ) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.settings = settings or Settings()
        self.rows_per_chunk = rows_per_chunk

    @cached_property
    def ticks(self) -> DataFrame:
        return events.event_ticks(self.spark, self.sf_dir)

    @cached_property
    def payloads(self) -> DataFrame:
        return events.event_payloads(self.spark, self.sf_dir)

    @cached_property
    def quotes(self) -> DataFrame:
        return events.event_quotes(self.spark, self.sf_dir)

    @cached_property
    def classified(self) -> DataFrame:
        return lateness.with_lateness(self.ticks, "arrival_seq", "event_ts_ms", rows_per_chunk=self.rows_per_chunk)

    @cached_property
    def accepted(self) -> DataFrame:
        return lateness.accepted(self.classified, self.settings.max_late_ms)

    @cached_property
    def bins(self) -> DataFrame:
        return bins.fold_ticks(self.accepted, self.settings.bin_ms, emitted_ms())

    @cached_property
    def arriving_bins(self) -> DataFrame:
        """Bins in a disordered arrival of up to 1.5 s, with lateness by their end times."""
        late = f"(start_ts_ms div 10) * {events.DISORDER_STEP} % {events.DISORDER_MS}"
        arrival = f"(end_ts_ms + {late}) * 1000000 + start_ts_ms % 1000000 AS arrival_seq"
        hour = F.expr("arrival_seq div 3600000000000")
        return lateness.with_lateness(self.bins.selectExpr("*", arrival), "arrival_seq", "end_ts_ms", chunk=hour)

    @cached_property
    def bars(self) -> DataFrame:
        return bars.fold_bins(self.bins, ingest=emitted_ms(), keep_grain=True)

    @cached_property
    def filled_bars(self) -> DataFrame:
        return gapfill.filled_bars(self.bins, self.settings.bin_ms, emitted_ms(), keep_grain=True)

    @cached_property
    def received_bars(self) -> DataFrame:
        return with_receipt(self.bars.drop(bars.GRAIN))

    @cached_property
    def minutes(self) -> DataFrame:
        return rollups.minute_bars(self.bars, keep_grain=True)

    @cached_property
    def counted(self) -> DataFrame:
        return rollups.counted_batches(self.minutes.drop(bars.GRAIN), self.settings.flush_minutes)

    @cached_property
    def aligned(self) -> DataFrame:
        return rollups.aligned_five_minutes(self.minutes)

    @property
    def load_ts(self) -> Column:
        return F.lit(LOAD_TS)

    @cached_property
    def facts_60s(self) -> DataFrame:
        return facts.fact_60s(self.minutes, self.load_ts)

    @cached_property
    def facts_300s(self) -> DataFrame:
        return facts.fact_300s(self.counted, self.load_ts)
