"""Queries and DuckDB texts of this package."""

from __future__ import annotations

from tessera.llm import backoff, chat, decontamination, language, licenses, merkle, mixing, near_dedup, neighbours, repair, secrets, sharding, toxicity

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_language_id": language.op2_language_id,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_backoff_scores": backoff.op4_backoff_scores,
    "op5_chat_formatting": chat.op5_chat_formatting,
    "op6_minhash_near_dedup": near_dedup.op6_minhash_near_dedup,
    "op7_hash_forest_ann": neighbours.op7_hash_forest_ann,
    "op8_hilbert_sharding": sharding.op8_hilbert_sharding,
    "op9_mixing": mixing.op9_mixing,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_license_scan": licenses.op11_license_scan,
    "op12_conversation_repair": repair.op12_conversation_repair,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLES = {
    "op1_decontamination": decontamination.ORACLE,
    "op5_chat_formatting": chat.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
