"""The decontamination query and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import decontam


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = decontam.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


OP6_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), strings AS (
    SELECT DISTINCT item_id, least(13, len(words)) AS size, array_to_string(words[k : k + least(13, len(words)) - 1], ' ') AS string
    FROM b, unnest(range(1, greatest(len(words) - 12, least(len(words), 1)) + 1)) AS t(k)
), sizes AS (SELECT DISTINCT size FROM strings),
places AS (
    SELECT row, size, k, array_to_string(words[k : k + size - 1], ' ') AS string
    FROM d, sizes, unnest(range(1, len(words) - size + 2)) AS t(k)
), hits AS (SELECT row, p.k, size, item_id FROM places p JOIN strings s USING (size, string)),
covered AS (SELECT row, count(DISTINCT w) AS n FROM hits, unnest(range(k, k + size)) AS t(w) GROUP BY row),
named AS (
    SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""
