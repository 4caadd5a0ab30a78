"""Parquet tables: refreshed dimensions, appended quotes, and notes on finished folders. Facts are in ``versioned``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

PARTITIONS = ["trade_date", "trade_hour"]


def overwrite(rows: DataFrame, path: str) -> None:
    """Full refresh of a small table."""
    rows.write.mode("overwrite").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True


def finish(spark: SparkSession, folder: str, batch: int) -> None:
    """Note that the folder holds the whole of this batch."""
    spark.range(batch, batch + 1).write.mode("overwrite").parquet(f"{folder}/note")


def finished(spark: SparkSession, folder: str, batch: int) -> bool:
    """Whether the folder holds the whole of this batch."""
    if not exists(spark, f"{folder}/note"):
        return False
    return not spark.read.parquet(f"{folder}/note").where(f"id = {batch}").isEmpty()
