"""Queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from loanlens.llm import bloom_lm, bpe, chat_windows, decontaminate, fim, jaccard_join, langid, mil_quality, pii, rendezvous, secrets, simhash, token_align

QUERIES = {
    "op1_language_id": langid.query,
    "op2_jaccard_join": jaccard_join.query,
    "op3_bpe_codec": bpe.query,
    "op4_simhash": simhash.query,
    "op5_decontaminate": decontaminate.query,
    "op6_pii": pii.query,
    "op7_bloom_lm": bloom_lm.query,
    "op8_mil_quality": mil_quality.query,
    "op9_chat_windows": chat_windows.query,
    "op10_secret_scan": secrets.query,
    "op11_rendezvous": rendezvous.query,
    "op12_token_align": token_align.query,
    "op13_fill_in_middle": fim.query,
}

ORACLE_SQL = {
    "op5_decontaminate": decontaminate.oracle_sql(),
    "op11_rendezvous": rendezvous.oracle_sql(),
    "op13_fill_in_middle": fim.oracle_sql(),
}
