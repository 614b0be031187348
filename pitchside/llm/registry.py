"""Queries of the corpus operators and their DuckDB SQL (only where SQL can express one)."""

from __future__ import annotations

from . import ann, embdedup, infill, langid, licenses, mixing, neardup, packing, phrases, pii, topk, toxicity, urls

QUERIES = {
    "op1_pack": packing.op1_pack,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_embedding_dedup": embdedup.op3_embedding_dedup,
    "op4_minhash": neardup.op4_minhash,
    "op5_licenses": licenses.op5_licenses,
    "op6_language": langid.op6_language,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_pii": pii.op8_pii,
    "op9_nearest": ann.op9_nearest,
    "op10_url_filter": urls.op10_url_filter,
    "op11_phrases": phrases.op11_phrases,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_top_k": topk.op13_top_k,
}

ORACLE_SQL = {
    "op2_mix_sources": mixing.SQL,
    "op5_licenses": licenses.SQL,
    "op8_pii": pii.SQL,
    "op11_phrases": phrases.SQL,
    "op12_fill_in_middle": infill.SQL,
    "op13_top_k": topk.SQL,
}
