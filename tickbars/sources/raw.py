"""Raw landing zone: one semi-structured record per line, with its load time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def land(lines: DataFrame, text: str = "value", load_ts: Column | dt.datetime | None = None) -> DataFrame:
    """Lines of JSON to ``record VARIANT, load_ts``; blank lines are skipped."""
    kept = lines.where(F.length(F.trim(text)) > 0)
    return kept.select(
        F.parse_json(text).alias("record"), (F.current_timestamp() if load_ts is None else F.lit(load_ts)).alias("load_ts")
    )


def land_files(spark: SparkSession, path: str) -> DataFrame:
    """Land gzip (or plain) JSON-lines files. Gzip does not split, so keep staged files to a task's size."""
    return land(spark.read.text(path))


def field(path: str, type_name: str, record: str = "record") -> Column:
    """One typed field of a landed record; null when it is absent or of another type."""
    return F.try_variant_get(F.col(record), path, type_name)
