"""The quality-rule query. Compression has no SQL; tests hold it against a plain version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import rules


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rules.judge_quality(docs)
