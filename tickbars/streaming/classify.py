"""Per-symbol watermarks on a stream.

Spark's own watermark is one per query: a symbol that runs ahead would make a quiet symbol's rows late. Here each
micro-batch is classified by the batch operator, which splits hot symbols into chunks, and starts from the
watermarks the batches before it left. Those are one row per symbol, written per batch to the shared checkpoint
folder, so a batch that is run again after a failure starts from the same watermarks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators import lateness, ordering
from tickbars.settings import MAX_LATE_MS
from tickbars.sources.ticks import numbered

WATERMARKS = "symbol STRING, watermark_ms BIGINT"


#: Micro-batches whose state is kept. A batch needs the state of the one before it, and may be run again.
KEPT_BATCHES = 4


def slot(path: str, batch: int) -> str:
    """The folder of a batch's state; it is overwritten ``KEPT_BATCHES`` batches later."""
    return f"{path}/slot={batch % KEPT_BATCHES}"


class BatchTable:
    """A small table under ``path`` on shared storage, as each of the last micro-batches left it.

    A batch reads what the one before it wrote and overwrites only its own folder, so running it again changes
    nothing. Folders are used in turn, so old states don't pile up. ``initial`` is what stands before the first batch.
    """

    def __init__(self, spark: SparkSession, path: str, initial: DataFrame) -> None:
        self.spark = spark
        self.path = path
        self.initial = initial

    def at(self, batch: int) -> DataFrame:
        if batch < 0:
            return self.initial
        return self.spark.read.schema(self.initial.schema).parquet(slot(self.path, batch))

    def before(self, batch: int) -> DataFrame:
        return self.at(batch - 1)

    def write(self, batch: int, rows: DataFrame) -> DataFrame:
        """Store the rows and read them back, which also cuts their lineage."""
        rows.write.mode("overwrite").parquet(slot(self.path, batch))
        return self.at(batch)


def watermark_table(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, spark.createDataFrame([], WATERMARKS))


def classify_batch(
    rows: DataFrame,
    before: DataFrame,
    order: str,
    time: str,
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Rows of one micro-batch with ``lateness_ms``, and the watermarks after it."""
    known = rows.join(before.withColumnRenamed("watermark_ms", "_known"), "symbol", "left")
    known = known.withColumn("_known", F.coalesce("_known", F.lit(0).cast("long")))
    classified = lateness.with_lateness(known, order, time, None, "_known", rows_per_chunk).drop("_known")
    newest = rows.groupBy("symbol").agg(F.max(time).alias("watermark_ms"))
    after = before.unionByName(newest).groupBy("symbol").agg(F.max("watermark_ms").alias("watermark_ms"))
    return classified, after


def split_stream(
    watermarks: BatchTable,
    order: str,
    time: str,
    on_accepted: Callable[[DataFrame, int], None],
    on_late: Callable[[DataFrame, int], None],
    max_late_ms: int = MAX_LATE_MS,
    rows_per_chunk: int = ordering.ROWS_PER_CHUNK,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that sends accepted and late rows to their sinks.

    Sinks take a batch number and overwrite what an earlier try of that batch wrote.
    """

    def handle(rows: DataFrame, batch: int) -> None:
        kept = numbered(rows, order).persist()
        try:
            classified, after = classify_batch(kept, watermarks.before(batch), order, time, rows_per_chunk)
            on_accepted(lateness.accepted(classified, max_late_ms), batch)
            on_late(lateness.late(classified, max_late_ms), batch)
            watermarks.write(batch, after)
        finally:
            kept.unpersist()

    return handle


def batch_folder_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to a folder of its own, replacing what an earlier try left there."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write
