"""The n-gram Jaccard join query. Components have no plain SQL; tests hold it against all links by brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import set_join


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.join_similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))
