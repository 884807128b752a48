"""The registered queries of this package and their DuckDB counterparts."""

from __future__ import annotations

from tessella.llm import chat, decontamination, exact, html_text, language, merkle, mixing, near, quality, secrets, shards, substrings, whitening

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_language_id": language.op2_language_id,
    "op3_shuffle_shards": shards.op3_shuffle_shards,
    "op4_jaccard_join": near.op4_jaccard_join,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_html_extraction": html_text.op7_html_extraction,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_exact_dedup": exact.op9_exact_dedup,
    "op10_quality": quality.op10_quality,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_chat_format": chat.op13_chat_format,
}
SQL = {"op4_jaccard_join": near.OP4_SQL, "op5_substring_dedup": substrings.OP5_SQL, "op6_decontamination": decontamination.OP6_SQL, "op9_exact_dedup": exact.OP9_SQL, "op12_merkle_manifest": merkle.OP12_SQL, "op13_chat_format": chat.OP13_SQL}
