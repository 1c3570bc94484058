"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, chat, decontam, embedding_join, license_scan, ngram_join, phrases, pii, quality, spelling, suffix_tree_lm, token_binary, url_filter

QUERIES = {
    "op1_byte_bpe": bpe.op1,
    "op2_url_filter": url_filter.op2,
    "op3_embedding_join": embedding_join.op3,
    "op4_ngram_join": ngram_join.op4,
    "op5_quality": quality.op5,
    "op6_chat": chat.op6,
    "op7_decontamination": decontam.op7,
    "op8_token_binary": token_binary.op8,
    "op9_suffix_tree_lm": suffix_tree_lm.op9,
    "op10_pii": pii.op10,
    "op11_license_scan": license_scan.op11,
    "op12_phrases": phrases.op12,
    "op13_spelling_variants": spelling.op13,
}

ORACLE_SQL = {
    "op2_url_filter": url_filter.SQL,
    "op6_chat": chat.SQL,
    "op7_decontamination": decontam.SQL,
    "op12_phrases": phrases.SQL,
}
