"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from candlewick.llm import bpe_dp, bucket_refinement, chunk_dedup, decontamination, language, periodic_runs, pii, ranked_search, rotation_codes, simhash, token_files, token_rollups, url_rules

QUERIES = {
    "op1_substring_dedup": chunk_dedup.op1_substring_dedup,
    "op2_suffix_array_dedup": bucket_refinement.op2_suffix_array_dedup,
    "op3_bpe_encode_decode": bpe_dp.op3_bpe_encode_decode,
    "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
    "op5_embedding_near_dedup": rotation_codes.op5_embedding_near_dedup,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op7_pii": pii.op7_pii,
    "op8_token_files": token_files.op8_token_files,
    "op9_language_id": language.op9_language_id,
    "op10_token_counts": token_rollups.op10_token_counts,
    "op11_ranked_search": ranked_search.op11_ranked_search,
    "op12_url_filters": url_rules.op12_url_filters,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLES = {
    "op5_embedding_near_dedup": rotation_codes.OP5_SQL,
    "op11_ranked_search": ranked_search.OP11_SQL,
    "op12_url_filters": url_rules.OP12_SQL,
}
