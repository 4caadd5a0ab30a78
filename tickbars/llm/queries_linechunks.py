"""The line-dedup query. Content-defined cutting has no SQL; tests hold it against a plain version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import linechunks


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.drop_repeated_chunks(spark.read.parquet(f"{sf_dir}/documents.parquet"))
