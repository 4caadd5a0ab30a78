"""The packing query. Tokenizing has no SQL; tests hold the pieces against the library and the bins against bounds."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import packing

END_ID = 1


def op5_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)
