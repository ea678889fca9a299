"""Registered queries of this package and their DuckDB oracles."""

from __future__ import annotations

from . import (
    best_fit_packing,
    block_max_wand,
    fill_middle,
    importance,
    language_id,
    lm_score,
    near_dedup,
    quality_rules,
    quality_trees,
    source_mixing,
    substring_dedup,
    toxicity,
    warc_zip,
)

QUERIES = {
    "op1_hyperminhash": near_dedup.op1_hyperminhash,
    "op2_lm_score": lm_score.op2_lm_score,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_source_mixing": source_mixing.op5_source_mixing,
    "op6_block_max_wand": block_max_wand.op6_block_max_wand,
    "op7_quality_trees": quality_trees.op7_quality_trees,
    "op8_warc_zip": warc_zip.op8_warc_zip,
    "op9_best_fit_packing": best_fit_packing.op9_best_fit_packing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_language_id": language_id.op11_language_id,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_fill_in_middle": fill_middle.op13_fill_in_middle,
}

ORACLE_SQL = {
    "op1_hyperminhash": near_dedup.OP1_SQL,
    "op3_substring_dedup": substring_dedup.OP3_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op5_source_mixing": source_mixing.OP5_SQL,
    "op6_block_max_wand": block_max_wand.OP6_SQL,
    "op8_warc_zip": warc_zip.OP8_SQL,
    "op13_fill_in_middle": fill_middle.OP13_SQL,
}
