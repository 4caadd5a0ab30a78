"""The quality score query. A trained network has no SQL; tests hold it to held-out accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import byte_cnn

LIMIT = 0.3
FOLDS = 5


def _held_out() -> Column:
    """Whether a row is never learnt from; a row without id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~_held_out())
    model = byte_cnn.train_classifier(docs, labels, "quality")
    scored = byte_cnn.score_texts(docs, model)
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
