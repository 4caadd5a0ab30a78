"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import (
    queries_alignment,
    queries_chat,
    queries_decontam,
    queries_exactdedup,
    queries_licences,
    queries_linechunks,
    queries_neardup,
    queries_packing,
    queries_prefix_trie,
    queries_quality,
    queries_rules,
    queries_set_join,
    queries_tokens,
)
from tickbars.llm.shared import shipped


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": queries_chat.op1_chat_format,
        "op2_token_count": queries_tokens.op2_token_count,
        "op3_license_scan": queries_licences.op3_license_scan,
        "op4_minhash_near_dedup": queries_neardup.op4_minhash_near_dedup,
        "op5_best_fit_pack": queries_packing.op5_best_fit_pack,
        "op6_decontaminate": queries_decontam.op6_decontaminate,
        "op7_quality_classifier": queries_quality.op7_quality_classifier,
        "op8_line_dedup": queries_linechunks.op8_line_dedup,
        "op9_suffix_dedup": queries_exactdedup.op9_suffix_dedup,
        "op10_quality_rules": queries_rules.op10_quality_rules,
        "op11_conversation_prefix_trie": queries_prefix_trie.op11_conversation_prefix_trie,
        "op12_tokenizer_alignment": queries_alignment.op12_tokenizer_alignment,
        "op13_ngram_jaccard_join": queries_set_join.op13_ngram_jaccard_join,
    }


def _sent(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(shipped(spark), sf_dir)


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _sent(query) for name, query in _queries().items()}


def oracle() -> dict[str, str]:
    return {
        "op1_chat_format": queries_chat.OP1_SQL,
        "op3_license_scan": queries_licences.OP3_SQL,
        "op6_decontaminate": queries_decontam.OP6_SQL,
        "op11_conversation_prefix_trie": queries_prefix_trie.OP11_SQL,
    }
