"""The queries of this subpackage by name, and their DuckDB SQL where it exists."""

from __future__ import annotations

from . import attention_lm, byte_bpe, decontaminate, near_dup, quality_gam, quality_rules, quote_threads, substring_dedup, token_store, url_filter

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_token_store": token_store.op3_token_store,
    "op4_quality_gam": quality_gam.op4_quality_gam,
    "op5_quote_threads": quote_threads.op5_quote_threads,
    "op6_attention_lm": attention_lm.op6_attention_lm,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op9_near_dup": near_dup.op9_near_dup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
}

ORACLES = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op2_decontaminate": decontaminate.ORACLE,
}
