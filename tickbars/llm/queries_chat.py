"""The chat formatting query, read back from the formatted text, and its SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import chat
from tickbars.llm.shared import column_of

SAMPLE = r"\### Assistant: </turn> ok"

SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose pieces arrive in order; only hash states are held, however long one is."""
    fields = [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in SCHEMA.split(", ")]
    key: object = batches  # no conversation has this id
    row: list = []
    out: list[list] = []

    def close() -> None:
        if row:
            out.append([row[0], row[1], row[2].hexdigest(), row[3], row[4].hexdigest(), row[5]])

    for batch in batches:
        columns = [column_of(batch, c).to_pylist() for c in ("conv_id", "text", "loss_start", "loss_end")]
        for conv, text, starts, ends in zip(*columns, strict=True):
            if conv != key:
                close()
                key, row = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said, _ in chat.read_turns(text):
                row[1] += 1
                row[2].update(f"{role}\n{said}\n".encode())
            for a, b in zip(starts, ends, strict=True):
                learnt = chat.unescaped(text[a:b])
                row[3] += len(learnt)
                row[4].update(learnt.encode())
            row[5] += len(text)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])
        out = []
    close()
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).selectExpr(
        "CAST(-7 AS BIGINT) AS conv_id",
        "id AS turn",
        "IF(id = 0, 'user', 'assistant') AS role",
        "r'" + SAMPLE + "' AS text",
    )
    pieces = chat.format_chats(table.unionByName(extra))
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "piece")
    return ordered.select("conv_id", "text", "loss_start", "loss_end").mapInArrow(_digests, SCHEMA)


OP1_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, length(regexp_replace(said, '(\\|### |</turn>)', '__\1', 'g')) - length(said) AS said_marks,
        length(regexp_replace(role, '(\\|### |</turn>|:)', '__\1', 'g')) - length(role) AS role_marks
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn NULLS FIRST, role, said)) AS turns_sha256,
    CAST(coalesce(sum(length(said)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(said, '' ORDER BY turn NULLS FIRST, role, said) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(14 + length(role) + length(said) + (said_marks + role_marks) // 2) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
