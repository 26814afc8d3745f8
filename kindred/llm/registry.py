"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from kindred.llm import decontaminate, language_id, ngram_join, packing, secret_scan, sharding, token_counts, topk, url_filter, warc

QUERIES = {
    "op1_label_propagation_sharding": sharding.op1_label_propagation_sharding,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_warc_index": warc.op4_warc_index,
    "op5_exact_topk": topk.op5_exact_topk,
    "op6_ngram_jaccard_join": ngram_join.op6_ngram_jaccard_join,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_language_id": language_id.op8_language_id,
    "op9_token_counts": token_counts.op9_token_counts,
}
ORACLE_SQL = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op4_warc_index": warc.OP4_SQL,
    "op5_exact_topk": topk.OP5_SQL,
}
