"""The near-duplicate query. Its SQL joins all pairs of shingle sets, too slow on whole tables; tests use brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import neardup


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
