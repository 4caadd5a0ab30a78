"""The conversation trie query with its rebuilt conversations, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import prefix_trie
from tickbars.llm.shared import stored

#: Conversations of one group start with the first turns of the group's first, fewer than HEADS of them.
GROUP, HEADS = 100, 6


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(steps, lengths) of the rebuilt conversations."""
    ordered = stored(prefix_trie.ordered_turns(turns), "ordered")
    sizes = ordered.groupBy("conv").agg(F.count("*").alias("n"))
    convs = sizes.select("conv", "n", (F.crc32(F.col("conv").cast("string")) % HEADS).alias("h"), F.expr(f"conv - conv % {GROUP} AS base"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = convs.withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stored(convs.select("conv", "base", "h", "head", F.expr("head + greatest(n - h, 0) AS length")), "conversations")
    heads = ordered.where(F.col("pos") < HEADS).withColumnRenamed("conv", "base")
    lead = convs.join(heads, "base").where("pos <= h").select("conv", "pos", "mark", "chars")
    own = ordered.join(convs, "conv").where("pos > h").select("conv", F.expr("pos - h + head AS pos"), "mark", "chars")
    return lead.unionByName(own), convs.select("conv", "length")


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps, lengths = rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.prefix_trie(steps, lengths).drop("node", "parent")


OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY b) AS crc FROM (
        SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
            CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v
        FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))
    )
), turns AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS said,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT conv, count(*) AS n FROM turns GROUP BY conv
), hashed AS (
    SELECT conv, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda x, y: xor(x // 256, crc[CAST(xor(x % 256, y) AS BIGINT) + 1])), 4294967295) % 6 AS h
    FROM sizes, crc_table
), convs AS (
    SELECT a.conv, a.h, a.conv - a.conv % 100 AS base, least(a.h, coalesce(b.n, 0)) AS head,
        least(a.h, coalesce(b.n, 0)) + greatest(a.n - a.h, 0) AS length
    FROM hashed a LEFT JOIN sizes b ON b.conv = a.conv - a.conv % 100
), steps AS (
    SELECT c.conv, t.pos, t.role, t.said, c.length FROM convs c JOIN turns t ON t.conv = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv, t.pos - c.h + c.head, t.role, t.said, c.length FROM convs c JOIN turns t ON t.conv = c.conv AND t.pos > c.h
), marked AS (
    SELECT conv, pos, length, length(said) AS chars, sha256(string_agg(sha256(strlen(role) || ':' || role || said), '')
        OVER (PARTITION BY conv ORDER BY pos)) AS node
    FROM steps
), rows_ AS (
    SELECT conv, pos, length, chars, node, coalesce(lag(node) OVER (PARTITION BY conv ORDER BY pos), 'root') AS parent FROM marked
    UNION ALL SELECT conv, 0, length, 0, 'root', NULL FROM convs
), nodes AS (
    SELECT node, min(parent) AS parent, min(pos) AS depth, min(conv) AS first, count(*) AS n_convs, min(chars) AS chars,
        sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (pos = length), '')) AS ends_sha256
    FROM rows_ GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), whole AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.node = n.node
), above AS (
    SELECT r.node AS top, n.n_children, (n.n_convs - 1) * n.chars AS saved
    FROM whole n JOIN rows_ r ON r.conv = n.first AND r.pos <= n.depth
), sums AS (
    SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM above GROUP BY top
)
SELECT n.first AS conv_id, CAST(n.depth AS BIGINT) AS depth, p.first AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
    s.saved_tokens, n.ends_sha256
FROM whole n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON p.node = n.parent
"""
