"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from tripmart.llm import (bpe, fim, html_text, mixing, neardup, negatives, neighbours, privacy, quality, sharding, simhash, token_counts,
                          urls)

QUERIES = {
    "op1_decision_list": quality.query,
    "op2_pareto_mix": mixing.query,
    "op3_feistel_shards": sharding.query,
    "op4_tag_path_ratios": html_text.query,
    "op5_icws_near_duplicates": neardup.query,
    "op6_bloom_cascade_urls": urls.query,
    "op7_tree_bpe": bpe.query,
    "op8_trie_token_counts": token_counts.query,
    "op9_disclosure_spans": privacy.query,
    "op10_projection_forest": neighbours.query,
    "op11_slot_negatives": negatives.query,
    "op12_golay_simhash": simhash.query,
    "op13_sorted_fim": fim.query,
}

ORACLES: dict[str, str] = {
    "op2_pareto_mix": mixing.ORACLE,
    "op6_bloom_cascade_urls": urls.ORACLE,
    "op11_slot_negatives": negatives.ORACLE,
    "op13_sorted_fim": fim.ORACLE,
}
