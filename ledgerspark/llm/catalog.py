"""Registered queries of this subpackage and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from . import conversations, decontamination, language, lines, minhash, packing, pii, quality, sharding, simhash, suffixes, toxicity, whitening

QUERIES = {
    "op1_pii": pii.query,
    "op2_decontamination": decontamination.query,
    "op3_suffix_dedup": suffixes.query,
    "op4_packing": packing.query,
    "op5_sharding": sharding.query,
    "op6_line_dedup": lines.query,
    "op7_simhash_near_dedup": simhash.query,
    "op8_language_id": language.query,
    "op9_quality_rules": quality.query,
    "op10_toxicity": toxicity.query,
    "op11_conversation_repair": conversations.query,
    "op12_minhash_near_dedup": minhash.query,
    "op13_embedding_whitening": whitening.query,
}

ORACLE = {
    "op1_pii": pii.oracle_sql(),
    "op6_line_dedup": lines.oracle_sql(),
    "op9_quality_rules": quality.oracle_sql(),
    "op11_conversation_repair": conversations.oracle_sql(),
    "op12_minhash_near_dedup": minhash.oracle_sql(),
}
