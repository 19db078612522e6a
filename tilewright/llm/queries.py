"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe_codec, collocations, decontamination, embedding_dedup, exact_dedup, fill_in_middle, license_scan, line_dedup, lm_scoring, ngram_join, packing, quality, token_counts

QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_embedding_near_dedup": embedding_dedup.op2_embedding_near_dedup,
    "op3_lm_scoring": lm_scoring.op3_lm_scoring,
    "op4_ngram_jaccard_join": ngram_join.op4_ngram_jaccard_join,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op5_license_scan": license_scan.op5_license_scan,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_bpe_round_trip": bpe_codec.op8_bpe_round_trip,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_benchmark_decontamination": decontamination.op11_benchmark_decontamination,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

ORACLE_SQL = {
    "op2_embedding_near_dedup": embedding_dedup.SQL,
    "op4_ngram_jaccard_join": ngram_join.SQL,
    "op7_line_dedup": line_dedup.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_benchmark_decontamination": decontamination.SQL,
    "op12_fill_in_middle": fill_in_middle.SQL,
    "op13_phrase_collocations": collocations.SQL,
}
