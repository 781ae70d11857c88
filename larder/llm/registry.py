"""The operators' queries and their DuckDB SQL, by registered name."""

from __future__ import annotations

from larder.llm import (cover_tree, decontaminate, laesa, packing, pfor, quality_rules, rule_ensemble, sharding,
                        simhash, suffix_tree, systematic, toxicity, warc)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_token_files": pfor.query,
    "op3_warc_chain": warc.query,
    "op4_spaced_seeds": decontaminate.query,
    "op5_label_propagation": sharding.query,
    "op6_simhash_pivots": simhash.query,
    "op7_toxicity": toxicity.query,
    "op8_suffix_tree": suffix_tree.query,
    "op9_rule_ensemble": rule_ensemble.query,
    "op10_best_fit_packing": packing.query,
    "op11_cover_tree": cover_tree.query,
    "op12_systematic_sampling": systematic.query,
    "op13_laesa_clustering": laesa.query,
}

SQL = {
    "op1_quality_rules": quality_rules.SQL,
    "op11_cover_tree": cover_tree.SQL,
    "op12_systematic_sampling": systematic.SQL,
    "op13_laesa_clustering": laesa.SQL,
}
