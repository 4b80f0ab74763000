"""Queries of this package and their DuckDB SQL, by registered name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedrank.llm import (bpe, chat, clusters, decontaminate, language_model, pii, prefix_trie,
                          quality, rules, simhash, token_counts, token_store, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_chat": chat.op3_chat,
    "op4_quality": quality.op4_quality,
    "op5_simhash": simhash.op5_simhash,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_bpe": bpe.op7_bpe,
    "op8_rules": rules.op8_rules,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_token_store": token_store.op10_token_store,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_clusters": clusters.op12_clusters,
    "op13_language_model": language_model.op13_language_model,
}

ORACLE_SQL: dict[str, str] = {
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_clusters": clusters.sql(),
}
