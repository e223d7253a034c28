"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from trendspark.llm import (
    collocations, decontaminate, html_wrapper, language_id, license_scan, log_bilinear, ngram_join, piece_codec, quality,
    sharding, suffix_dedup, token_align, topk_search)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_piece_codec": piece_codec.op2_piece_codec,
    "op3_ngram_jaccard": ngram_join.op3_ngram_jaccard,
    "op4_exact_topk": topk_search.op4_exact_topk,
    "op5_quality": quality.op5_quality,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_sharding": sharding.op7_sharding,
    "op8_html_extract": html_wrapper.op8_html_extract,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_token_align": token_align.op11_token_align,
    "op12_collocations": collocations.op12_collocations,
    "op13_log_bilinear": log_bilinear.op13_log_bilinear,
}

ORACLE = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op4_exact_topk": topk_search.OP4_SQL,
    "op6_license_scan": license_scan.OP6_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
