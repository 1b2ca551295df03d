"""Queries of this folder and their oracle SQL."""

from __future__ import annotations

from aulaframe.llm import (
    conversations, exact_dedup, fingerprints, licenses, lm_scoring, mixing, ngram_join, packing, periodic_runs, token_files, topk, toxicity, warc)

QUERIES = {f.__name__: f for f in (
    packing.op1_pack_best_fit, mixing.op2_mix_sources, ngram_join.op3_ngram_jaccard_join, exact_dedup.op4_exact_dedup,
    warc.op5_warc_segments, lm_scoring.op6_maxent_lm, token_files.op7_token_files, topk.op8_pivot_topk,
    toxicity.op9_toxicity, licenses.op10_license_join, conversations.op11_conversation_repair,
    fingerprints.op12_bloom_fingerprints, periodic_runs.op13_periodic_runs)}

ORACLES = {
    "op2_mix_sources": mixing.OP2_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_warc_segments": warc.OP5_SQL,
    "op8_pivot_topk": topk.OP8_SQL,
    "op10_license_join": licenses.OP10_SQL,
    "op11_conversation_repair": conversations.OP11_SQL,
    "op12_bloom_fingerprints": fingerprints.OP12_SQL,
    "op13_periodic_runs": periodic_runs.OP13_SQL,
}
