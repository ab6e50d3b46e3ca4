"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from agroclim.llm import (
    ann,
    bpe,
    collocations,
    language_model,
    line_dedup,
    minhash,
    mixing,
    periodic_runs,
    pii,
    quality,
    sentence_pieces,
    token_counts,
    url_filter,
)

QUERIES = {
    "op1_minhash_near_dedup": minhash.op1_minhash_near_dedup,
    "op2_language_model": language_model.op2_language_model,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_learned_partitions": ann.op4_learned_partitions,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_source_mix": mixing.op6_source_mix,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_personal_data": pii.op9_personal_data,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_sentence_pieces": sentence_pieces.op11_sentence_pieces,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_minhash_near_dedup": minhash.OP1_SQL,
    "op6_source_mix": mixing.OP6_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op12_phrase_collocations": collocations.OP12_SQL,
}
