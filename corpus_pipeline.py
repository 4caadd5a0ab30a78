"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import decontam, linechunks, neardup, packing, rules
from tickbars.llm.shared import named, shipped, stored

TOKENIZER, END_ID = "word_bpe_49k.json", 1
PREFIX = "__stage_"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the word rules and compression bands accept.

    Null and empty texts are rejected; repeated rows are judged alike; texts of any length are judged whole; nulls in other
    columns and any other columns pass through; an empty table stays empty.
    """
    judged = rules.judge_quality(docs, keep=tuple(docs.columns), prefix=PREFIX, only_kept=True)
    return judged.select(*map(named, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks of lines that stand elsewhere before; a row goes if nothing of its text is left.

    Null and empty texts stay as they are, and so do texts of one line; repeated rows are one document; of equal chunks the
    one with the smallest id and position stays (null ids first); texts of any length are cut whole; ``n_chars`` follows the
    text, other columns pass through; an empty table stays empty.
    """
    cut = linechunks.drop_repeated_chunks(docs, keep=tuple(docs.columns), prefix=PREFIX)
    cut = cut.where(f"{PREFIX}n_lines = 0 OR {PREFIX}n_removed_lines < {PREFIX}n_lines")
    if "n_chars" in docs.columns:
        changed = F.when(F.col(f"{PREFIX}n_removed_lines") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        cut = cut.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return cut.select(*map(named, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies.

    The smallest id stays (null ids last; ties by a hash of id and text). Texts without words, null ones included, are linked
    with nothing; of rows that repeat id and text one stays; texts of any length count whole; other columns pass through; an
    empty table stays empty.
    """
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated with benchmark passages.

    Null and empty texts have no words and stay; repeated rows are judged alike; texts of any length are searched whole; other
    columns pass through; an empty table or benchmark changes nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.find_contamination(docs, benchmark, keep=tuple(docs.columns), prefix=PREFIX)
    return found.where(f"NOT {PREFIX}contaminated").select(*map(named, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a text goes in the training sequences.

    Null and empty texts are the end id alone; repeated rows are packed each; null ids stay; texts of any length are packed
    whole; other columns are left out; an empty table gives no rows.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Compression, content-defined cutting and tokenizing have no SQL; a test holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
