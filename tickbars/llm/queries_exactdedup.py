"""The query on repeated byte strings. Its SQL would list every place; tests use brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import exactdedup


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = exactdedup.remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What is left as text; a character that was cut through shows as a replacement character.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )
