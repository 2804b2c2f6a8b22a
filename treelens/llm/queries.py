"""Registered queries of the package and the SQL that some of them equal."""

from __future__ import annotations

from treelens.llm import bpe_codec, decontamination, line_blocks, packing, pii, quality, ranked_search, repair, simhash, substrings, token_counts, toxicity, vectors

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_line_dedup": line_blocks.op4_line_dedup,
    "op5_pii": pii.op5_pii,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_benchmark_decontamination": decontamination.op7_benchmark_decontamination,
    "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
    "op9_embedding_near_dedup": vectors.op9_embedding_near_dedup,
    "op10_bpe_codec": bpe_codec.op10_bpe_codec,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_sequence_packing": packing.op13_sequence_packing,
}

#: The others train models, need XXH64 or a tokenizer, follow positions of matches or choose edits; they are tested against brute force.
ORACLES = {
    "op2_substring_dedup": substrings.OP2_SQL,
    "op7_benchmark_decontamination": decontamination.OP7_SQL,
    "op9_embedding_near_dedup": vectors.OP9_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
}
