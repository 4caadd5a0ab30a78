"""Ticks to bins to bars to minutes to facts on a stream, with per-symbol watermarks throughout.

A pipeline starts from ticks, from a topic of bins or from a topic of bars; one streaming query feeds all its stages. A
stage keeps the rows of windows that are still open in a table per micro-batch, folds the windows that closed with the
batch operators, and hands them on. Its state is the open rows (half a second of ticks or bins, a minute of bars, four
minutes) and one watermark per symbol; minutes are folded from the stored seconds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickbars.functions import scalars as x
from tickbars.operators import bars, bins, facts, gapfill, json_contracts, lateness, ordering, rollups
from tickbars.session import shared_folder
from tickbars.settings import IDLE_SETTLE_MS, MINUTE_MS, SECOND_MS, SETTLE_GRACE_MS, Settings
from tickbars.sinks import messages, tables, versioned
from tickbars.sources.ticks import numbered
from tickbars.streaming.classify import BatchTable, classify_batch, slot, watermark_table

CLOSED = "_closed"


class OpenRows:
    """Rows of windows not closed yet, written beside the closed ones of the same micro-batch in one pass."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _part(self, batch: int, closed: bool, like: DataFrame) -> DataFrame:
        if batch < 0:
            return like.limit(0)
        whole = like.withColumn(CLOSED, F.lit(True)).schema
        rows = self.spark.read.schema(whole).parquet(slot(self.path, batch))
        return rows.where(F.col(CLOSED) == closed).drop(CLOSED)

    def advance(self, batch: int, arrived: DataFrame, closes: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Pool the open rows with the arrived ones, mark those whose window closed, and return these.

        ``closes`` may also merge rows or change their columns.
        """
        pool = self._part(batch - 1, False, arrived).unionByName(arrived)
        marked = closes(pool).select(*arrived.columns, CLOSED)
        marked.write.mode("overwrite").partitionBy(CLOSED).parquet(slot(self.path, batch))
        return self._part(batch, True, arrived)

    def open_at(self, batch: int, like: DataFrame) -> DataFrame:
        return self._part(batch, False, like)


def _closed_by(watermarks: DataFrame, end: Column, max_late_ms: int) -> Callable[[DataFrame], DataFrame]:
    """Windows whose end lies before their symbol's watermark less the allowed lateness.

    Strictly before: a row exactly at the bound is still accepted, so its window must still be open.
    """

    def mark(pool: DataFrame) -> DataFrame:
        joined = pool.join(watermarks, "symbol", "left")
        return joined.withColumn(CLOSED, F.coalesce(end < F.col("watermark_ms") - max_late_ms, F.lit(False)))

    return mark


class Stages:
    """What all pipelines share: outputs, and the way from bars to minutes and fact tables under ``root``.

    Without a ``root`` everything goes below the folder the cluster names in ``spark.checkpoint.dir``; put it on shared
    storage. Outputs have one folder per micro-batch, and the tables ``fact_1s``, ``fact_60s`` and ``fact_300s`` are
    upserted. ``send`` gets the keyed messages of every batch (topic name, messages, batch number), say for Kafka;
    without it they go to ``messages/<topic>``. State is kept for the last few batches only. With a ``contract`` (a JSON
    Schema) arriving bins or bars that break it are stored as ``rejected_bins`` or ``rejected_bars``, with the rules they
    break, and go no further.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        settings: Settings | None = None,
        ingest: Column | None = None,
        load_ts: Column | dt.datetime | None = None,
        now_ms: Callable[[], int] | None = None,
        rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
        send: Callable[[str, DataFrame, int], None] | None = None,
        contract: dict | None = None,
    ) -> None:
        self.spark = spark
        root = shared_folder(spark, self.NAME) if root is None else root
        self.root = root
        self.settings = settings or Settings()
        self.ingest = ingest
        self.load_ts = load_ts
        self.now_ms = now_ms
        self.rows_per_chunk = rows_per_chunk
        self.send = send
        self.contract = contract
        self.marks = watermark_table(spark, f"{root}/state/watermarks")
        clock = spark.createDataFrame([], "batch BIGINT, settled_at BIGINT, before BIGINT")
        self.clock = BatchTable(spark, f"{root}/state/clock", clock)
        self.open_rows = OpenRows(spark, f"{root}/state/open_rows")
        self.open_bars = OpenRows(spark, f"{root}/state/open_bars")
        self.open_minutes = OpenRows(spark, f"{root}/state/open_minutes")

    NAME = "stages"

    def __call__(self, rows: DataFrame, batch: int) -> None:
        self.run(rows, batch)

    def run(self, rows: DataFrame, batch: int, drain: bool = False) -> None:
        """Process one micro-batch. With ``drain`` every open window is closed, as at the end of a replay."""
        new_bars = self.to_bars(rows, batch, drain)
        self._upsert("fact_1s", facts.fact_1s(new_bars, self.load_ts), batch)
        self._store("rejects", batch, facts.rejects(new_bars))
        minutes = self._bars_to_minutes(new_bars, batch, drain)
        self._minutes_to_facts(minutes, batch, drain)

    def to_bars(self, rows: DataFrame, batch: int, drain: bool) -> DataFrame:
        raise NotImplementedError

    def drain(self, batch: int, like: DataFrame) -> None:
        """Close everything that is open, as a batch of its own after the last one."""
        self.run(like.limit(0), batch, drain=True)

    def _upsert(self, name: str, rows: DataFrame, batch: int) -> None:
        versioned.upsert(self.spark, rows, f"{self.root}/{name}", batch=batch)

    def _store(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        """Write an output folder and read it back: later steps start from stored rows."""
        path = f"{self.root}/{name}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _decided(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        """The rows as this batch first saw them, stored before any table changes, for a batch that is run again."""
        folder = slot(f"{self.root}/state/{name}", batch)
        if not tables.finished(self.spark, folder, batch):
            rows.write.mode("overwrite").parquet(f"{folder}/rows")
            tables.finish(self.spark, folder, batch)
        return self.spark.read.schema(rows.schema).parquet(f"{folder}/rows")

    def _emit(self, topic: str, sent: DataFrame, batch: int) -> None:
        if self.send is not None:
            self.send(topic, sent, batch)
        else:
            sent.write.mode("overwrite").json(f"{self.root}/messages/{topic}/batch={batch}")

    def _checked(self, name: str, rows: DataFrame, batch: int) -> DataFrame:
        """Rows that keep the contract; the others are stored."""
        if self.contract is None:
            return rows
        good, broken = json_contracts.quarantine(rows, json_contracts.row_rules(self.contract, rows))
        self._store(name, batch, broken)
        return good

    def _judged(self, rows: DataFrame, time: str, batch: int) -> tuple[DataFrame, DataFrame]:
        """Rows with their lateness, and the symbols' watermarks after this batch."""
        classified, after = classify_batch(rows, self.marks.before(batch), "arrival_seq", time, self.rows_per_chunk)
        return classified, self.marks.write(batch, after)

    def _facts(self, name: str, like: DataFrame, touched: DataFrame) -> DataFrame:
        """Stored facts of the hours that ``touched`` (with ``start_ts``) lies in."""
        return versioned.in_hours(self.spark, f"{self.root}/{name}", facts.with_trade_hour(like).schema, touched)

    def _bars_to_minutes(self, new_bars: DataFrame, batch: int, drain: bool) -> DataFrame:
        """Minute bars that are due, with whether they are ``final``.

        A minute is final with the first bar of a later one. Once idle long enough it is given early, and again when more
        of its seconds have come. A due minute is always folded from all its stored seconds, so whoever keeps the last
        copy of a key has the whole minute, also when a second comes after its minute was final.
        """
        settled = self._settle_before(batch)
        minute = x.floor_ms("start_ts_ms", MINUTE_MS)
        arrived = new_bars.select("symbol", minute.alias("minute_ms"), F.lit(False).alias("given"), F.lit(False).alias("due"))

        def closes(pool: DataFrame) -> DataFrame:
            each = pool.groupBy("symbol", "minute_ms").agg(F.bool_and("given").alias("given"))
            newest = pool.groupBy("symbol").agg(F.max("minute_ms").alias("_newest"))
            done = F.lit(True) if drain else F.col("minute_ms") < F.col("_newest")
            idle = F.lit(False) if settled is None else F.col("minute_ms") + MINUTE_MS <= F.lit(settled)
            early = ~done & idle
            marked = each.join(newest, "symbol").withColumn(CLOSED, done)
            return marked.withColumn("due", early & ~F.col("given")).withColumn("given", early | F.col("given"))

        closed = self.open_bars.advance(batch, arrived, closes)
        early = self.open_bars.open_at(batch, arrived).where("due")
        keys = closed.withColumn("final", F.lit(True)).unionByName(early.withColumn("final", F.lit(False)))
        keys = keys.select("symbol", "minute_ms", "final").withColumn("start_ts", x.ms_to_timestamp("minute_ms"))
        seconds = self._facts("fact_1s", facts.fact_1s(new_bars, self.load_ts), keys)
        timed = seconds.withColumn("start_ts_ms", x.timestamp_to_ms("start_ts")).withColumn(
            "ingest_ts_ms", x.timestamp_to_ms("ingest_ts")
        )
        due = timed.withColumn("minute_ms", minute).join(keys.drop("start_ts"), ["symbol", "minute_ms"])
        folded = rollups.minute_bars(due)
        final = keys.select("symbol", F.col("minute_ms").alias("start_ts_ms"), "final")
        return self._store("minutes", batch, folded.join(final, ["symbol", "start_ts_ms"]).select(*folded.columns, "final"))

    def _settle_before(self, batch: int) -> int | None:
        """Every so often, the time before which idle minutes are given early.

        The clock is read once per batch and its answer stored, so a batch that is run again decides alike.
        """
        if self.now_ms is None:
            return None
        known = self.clock.at(batch).where(f"batch = {batch}").first() if self._has_clock(batch) else None
        if known is None:
            last = self.clock.before(batch).first() if self._has_clock(batch - 1) else None
            now, at = self.now_ms(), last.settled_at if last else None
            due = at is None or now - at >= IDLE_SETTLE_MS
            row = (batch, now if due else at, now - SETTLE_GRACE_MS if due else None)
            self.clock.write(batch, self.spark.createDataFrame([row], self.clock.initial.schema))
            known = self.clock.at(batch).first()
        return known.before

    def _has_clock(self, batch: int) -> bool:
        return batch >= 0 and tables.exists(self.spark, slot(self.clock.path, batch))

    def _minutes_to_facts(self, minutes: DataFrame, batch: int, drain: bool) -> None:
        """Final minutes are flushed in full batches, each with its five-minute bar; a drain flushes the rest.

        Minutes given early go straight to the facts, without a place in a batch. A minute that comes again after it was
        flushed keeps its place, and the five-minute bar it is part of is folded anew.
        """
        size = self.settings.flush_minutes
        touched = minutes.withColumn("start_ts", x.ms_to_timestamp("start_ts_ms"))
        stored = self._facts("fact_60s", facts.fact_60s(minutes, self.load_ts), touched)
        places = stored.where("minute_index IS NOT NULL").select("bar_id", F.col("minute_index").alias("_place"))
        known = self._decided("due_minutes", batch, minutes.join(places, "bar_id", "left"))
        again = known.where("_place IS NOT NULL")
        plain = [c for c in minutes.columns if c != "final"]
        fresh = known.where("_place IS NULL AND final").select(*plain).withColumn("batch_no", F.lit(batch).cast("long"))

        def full(pool: DataFrame) -> DataFrame:
            once = bars.last_per_key(pool, "bar_id", "batch_no")
            indexed = rollups.with_minute_ordinal(once)
            count = indexed.groupBy("symbol").agg(F.max("minute_ordinal").alias("_count"))
            whole = F.col("_count") - F.pmod(F.col("_count"), F.lit(size))
            done = F.lit(True) if drain else F.col("minute_ordinal") <= whole
            return indexed.join(count, "symbol", "left").withColumn(CLOSED, done)

        flushed = self.open_minutes.advance(batch, fresh, full).drop("batch_no")
        place = F.col("minute_index").cast("int")
        rows = rollups.minute_index(flushed, size).select(*plain, place.alias("minute_index"))
        early = known.where("_place IS NULL AND NOT final").select(*plain, F.lit(None).cast("int").alias("minute_index"))
        rows = rows.unionByName(early).unionByName(again.select(*plain, F.col("_place").cast("int").alias("minute_index")))
        self._upsert("fact_60s", facts.fact_60s(rows, self.load_ts), batch)
        five = facts.fact_300s(rollups.counted_batches(flushed, size), self.load_ts)
        self._upsert("fact_300s", five.unionByName(self._refolded(again, five)), batch)

    def _refolded(self, again: DataFrame, like: DataFrame) -> DataFrame:
        """Five-minute bars that hold a minute which came again, folded from the stored minutes of their span."""
        at = again.select("symbol", x.ms_to_timestamp("start_ts_ms").alias("start_ts"))
        around = at.unionByName(at.withColumn("start_ts", F.col("start_ts") - F.expr("INTERVAL 1 HOUR")))
        old = self._facts("fact_300s", like, around).select(*like.columns)
        inside = (F.col("m.start_ts") >= F.col("f.start_ts")) & (F.col("m.start_ts") < F.col("f.end_ts"))
        hit = old.alias("f").join(at.alias("m"), (F.col("f.symbol") == F.col("m.symbol")) & inside, "left_semi")
        minutes = self._facts("fact_60s", facts.fact_60s(again, self.load_ts), around).where("minute_index IS NOT NULL")
        spans = hit.select("bar_id", "symbol", "start_ts", "end_ts", "minute_count", "load_ts")
        parts = minutes.drop("bar_id", "load_ts").alias("m").join(spans.alias("f"), (F.col("f.symbol") == F.col("m.symbol")) & inside)
        folded = parts.groupBy("f.bar_id", "f.symbol", "f.start_ts", "f.end_ts", "f.load_ts", "f.minute_count").agg(
            F.min_by("open", "m.start_ts").alias("open"),
            F.max_by("close", "m.start_ts").alias("close"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
            F.sum("notional").alias("notional"),
            F.max("ingest_ts").alias("ingest_ts"),
            F.sum("source_count").alias("source_count"),
        )
        return folded.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


class TickPipeline(Stages):
    """A ``foreachBatch`` handler from ticks to bins, bars and fact tables.

    Outputs beside those of ``Stages``: ``bins``, ``bars``, ``late_ticks``, and bin and bar messages.
    """

    NAME = "tick-pipeline"

    def __init__(self, spark: SparkSession, root: str | None = None, settings: Settings | None = None, fill_gaps: bool = True, **kwargs) -> None:
        super().__init__(spark, root, settings, **kwargs)
        self.fill_gaps = fill_gaps
        last = spark.createDataFrame([], "symbol STRING, start_ts_ms BIGINT, close DECIMAL(18,6)")
        self.last_bins = BatchTable(spark, f"{self.root}/state/last_bins", last)
        self.open_pieces = OpenRows(spark, f"{self.root}/state/open_pieces")

    def to_bars(self, rows: DataFrame, batch: int, drain: bool) -> DataFrame:
        return self._bins_to_bars(self._ticks_to_bins(rows, batch, drain), batch, drain)

    def _ticks_to_bins(self, ticks: DataFrame, batch: int, drain: bool) -> DataFrame:
        late_ms = self.settings.max_late_ms
        kept = numbered(ticks, "arrival_seq").persist()
        try:
            classified, marks = self._judged(kept, "event_ts_ms", batch)
            self._store("late_ticks", batch, lateness.late_tick_letters(classified, late_ms))
            end = x.floor_ms("event_ts_ms", self.settings.bin_ms) + self.settings.bin_ms
            placed, order = lateness.accepted(classified, late_ms), "arrival_seq"
            if "arrival_seq" not in ticks.columns:
                # Numbers given here restart in each batch, so the batch number leads.
                placed, order = placed.withColumn("batch_no", F.lit(batch).cast("long")), "arrival"
            closed = self.open_rows.advance(batch, placed, _all() if drain else _closed_by(marks, end, late_ms))
        finally:
            kept.unpersist()
        if order == "arrival":
            closed = closed.withColumn("arrival", F.struct("batch_no", "arrival_seq"))
        folded = self._store("bins", batch, bins.fold_ticks(closed, self.settings.bin_ms, self.ingest, order))
        self._emit("bins", messages.bin_messages(folded), batch)
        return folded

    def _bins_to_bars(self, new_bins: DataFrame, batch: int, drain: bool) -> DataFrame:
        """Bins come out of the first stage in order, so a symbol's last bin is its watermark, and its carried price."""
        late_ms, bin_ms = self.settings.max_late_ms, self.settings.bin_ms
        parts = gapfill.real_pieces(new_bins)
        known = self.last_bins.before(batch).unionByName(new_bins.select("symbol", "start_ts_ms", "close"))
        if self.fill_gaps:
            parts = parts.unionByName(gapfill.filler_pieces(known, SECOND_MS, bin_ms))
        newest = known.groupBy("symbol").agg(
            F.max("start_ts_ms").alias("start_ts_ms"), F.max_by("close", "start_ts_ms").alias("close")
        )
        marks = self.last_bins.write(batch, newest).selectExpr("symbol", f"start_ts_ms + {bin_ms} AS watermark_ms")
        end = x.floor_ms("first_ms", SECOND_MS) + SECOND_MS
        closed = self.open_pieces.advance(batch, parts, _all() if drain else _closed_by(marks, end, late_ms))
        folded = self._store("bars", batch, gapfill.fold_pieces(closed, self.ingest))
        self._emit("bars", messages.bar_messages(folded), batch)
        return folded


class BinPipeline(Stages):
    """A ``foreachBatch`` handler from a topic of bins (``streams.bin_stream``) to bars and fact tables.

    Missing fields are filled, bins delivered again count once, and bins too far behind their symbol's newest end go to
    ``late_bins``. Outputs beside those of ``Stages``: ``bars``, ``late_bins`` and bar messages. Of a bin that comes
    again only copies within the allowed lateness matter: later ones are late.
    """

    NAME = "bin-pipeline"

    def to_bars(self, rows: DataFrame, batch: int, drain: bool) -> DataFrame:
        late_ms = self.settings.max_late_ms
        filled = bins.with_defaults(self._checked("rejected_bins", rows, batch), self.settings.bin_ms)
        filled = filled.withColumn("bin_id", F.coalesce("bin_id", x.series_id("symbol", "start_ts_ms")))
        kept = numbered(filled, "arrival_seq").persist()
        try:
            classified, marks = self._judged(kept, "end_ts_ms", batch)
            self._store("late_bins", batch, lateness.late_bin_letters(classified, late_ms))
            end = x.floor_ms("start_ts_ms", SECOND_MS) + SECOND_MS
            mark = _all() if drain else _closed_by(marks, end, late_ms)
            accepted = lateness.accepted(classified, late_ms)
            closed = self.open_rows.advance(batch, accepted, lambda pool: mark(bins.dedupe(pool)))
        finally:
            kept.unpersist()
        folded = bars.fold_bins(closed, F.col("lateness_ms"), self.ingest)
        folded = self._store("bars", batch, folded)
        self._emit("bars", messages.bar_messages(folded), batch)
        return folded


class BarPipeline(Stages):
    """A ``foreachBatch`` handler from a topic of bars (``streams.bar_stream``) to minutes and fact tables.

    Missing fields are filled; of the copies of a bar the last one counts.
    """

    NAME = "bar-pipeline"

    def to_bars(self, rows: DataFrame, batch: int, drain: bool) -> DataFrame:
        filled = rollups.with_defaults(self._checked("rejected_bars", rows, batch), self.ingest)
        filled = (
            filled.withColumn("bar_id", F.coalesce("bar_id", x.series_id("symbol", "start_ts_ms")))
            .withColumn("end_ts_ms", F.coalesce("end_ts_ms", F.col("start_ts_ms") + SECOND_MS))
            .withColumn("vwap", F.coalesce(F.col("vwap").cast("double"), F.expr(x.VWAP)))
            .withColumn("bin_count", F.coalesce("bin_count", F.lit(0)))
            .withColumn("max_lateness_ms", F.coalesce("max_lateness_ms", F.lit(0)))
        )
        once = bars.last_per_key(numbered(filled, "arrival_seq"), "bar_id", "arrival_seq")
        return self._store("bars", batch, once.drop("arrival_seq"))


def _all() -> Callable[[DataFrame], DataFrame]:
    return lambda pool: pool.withColumn(CLOSED, F.lit(True))


def start(
    stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, until_idle: bool = False
) -> StreamingQuery:
    """Start a query with its progress in ``checkpoint``; with ``until_idle`` it stops when the input is used up."""
    writer: DataStreamWriter = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if until_idle:
        writer = writer.trigger(availableNow=True)
    return writer.start()
