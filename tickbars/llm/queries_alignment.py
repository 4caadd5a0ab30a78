"""The cross-tokenizer alignment query. Tokenizing has no SQL; tests hold it against a plain version."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import alignment

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return alignment.align_tokenizers(docs, public_tokenizers.path(A), public_tokenizers.path(B))
