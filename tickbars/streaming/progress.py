"""Progress of streaming queries as a table: input rate, batch time, and how far a query is behind its sources.

Spark tells a listener about every micro-batch. What it says is kept in memory and appended to the table as one small file
for several batches, so neither a job per batch nor a file per batch comes of it.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query STRING, run_id STRING, batch BIGINT, at TIMESTAMP, input_rows BIGINT, input_rate DOUBLE, processed_rate DOUBLE, "
    "batch_ms BIGINT, behind BIGINT, late_rows BIGINT, state_rows BIGINT, state_bytes BIGINT"
)


def _numbers(offset) -> dict[tuple, int]:
    """The numbers in a source's offset by where they stand: a Kafka offset is a map of topics and partitions."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return {}
    found: dict[tuple, int] = {}

    def walk(at: tuple, value) -> None:
        if isinstance(value, bool):
            return
        if isinstance(value, int):
            found[at] = value
        elif isinstance(value, dict):
            for k, v in value.items():
                walk((*at, k), v)

    walk((), offset)
    return found


def behind(sources: Iterable) -> int | None:
    """How many offsets the sources hold beyond what was read; null where no source tells.

    Kafka gives its latest offsets beside those read. A file source tells nothing; its lag shows in input and batch times.
    """
    total = None
    for source in sources:
        latest, end = _numbers(source.latestOffset), _numbers(source.endOffset)
        shared = latest.keys() & end.keys()
        if shared:
            total = (total or 0) + sum(max(latest[k] - end[k], 0) for k in shared)
    return total


class ProgressTable(StreamingQueryListener):
    """A listener that appends the progress of all queries of a session to the table at ``path``.

    Rows are written after ``every`` batches and whenever a query ends; ``flush`` writes what is held. A listener only
    watches: a fault while writing must not end a query, so the rows stay held and go with the next write.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20) -> None:
        super().__init__()
        self.spark = spark
        self.path = path
        self.every = every
        self.held: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = list(p.stateOperators or [])
        row = (
            p.name or str(p.id),
            str(p.runId),
            p.batchId,
            p.timestamp,
            p.numInputRows,
            float(p.inputRowsPerSecond),
            float(p.processedRowsPerSecond),
            p.batchDuration,
            behind(p.sources),
            sum(s.numRowsDroppedByWatermark for s in state),
            sum(s.numRowsTotal for s in state),
            sum(s.memoryUsedBytes for s in state),
        )
        with self.lock:
            self.held.append(row)
            full = len(self.held) >= self.every
        if full:
            self._try_flush()

    def onQueryTerminated(self, event) -> None:
        self._try_flush()

    def _try_flush(self) -> None:
        try:
            self.flush()
        except Exception as fault:  # noqa: BLE001
            print(f"progress not written yet: {fault}")

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if not rows:
            return
        schema = PROGRESS.replace("at TIMESTAMP", "at STRING")
        try:
            frame = self.spark.createDataFrame(rows, schema).withColumn("at", F.to_timestamp("at"))
            frame.coalesce(1).write.mode("append").parquet(self.path)
        except Exception:
            with self.lock:
                self.held = rows + self.held
            raise


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)


def latest(progress: DataFrame) -> DataFrame:
    """The newest row of each query; an aggregate, however long the history."""
    body = [c for c in progress.columns if c != "query"]
    newest = F.max_by(F.struct(*body), F.struct("at", "batch"))
    return progress.groupBy("query").agg(newest.alias("_row")).select("query", "_row.*")


def with_backlog(metrics: DataFrame, progress: DataFrame) -> DataFrame:
    """The one row of ``serving.gap_metrics`` beside what the queries say: how many there are, the records they are behind in
    all, the slowest one's batch time, their input rate, and the oldest of their last signs of life."""
    newest = latest(progress).agg(
        F.count(F.lit(1)).alias("queries"),
        F.sum("behind").alias("behind"),
        F.max("batch_ms").alias("slowest_batch_ms"),
        F.coalesce(F.sum("input_rate"), F.lit(0.0)).alias("input_rate"),
        F.unix_millis(F.min("at")).alias("stalest_ms"),
    )
    row = newest.select(F.struct("*")).scalar()
    return metrics.select("*", *[row.getField(c).alias(c) for c in newest.columns])
