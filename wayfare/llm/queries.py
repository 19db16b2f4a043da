"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from wayfare.llm import (
    decontaminate,
    eliasfano,
    language,
    licenses,
    mtree,
    ngramjoin,
    packing,
    periods,
    pii,
    prefixcounts,
    prefixtrie,
    secretscan,
    toxicity,
)

QUERIES = {
    "op1_m_tree": mtree.op1_m_tree,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_ngram_join": ngramjoin.op3_ngram_join,
    "op4_personal_data": pii.op4_personal_data,
    "op5_elias_fano": eliasfano.op5_elias_fano,
    "op6_secrets": secretscan.op6_secrets,
    "op7_best_fit": packing.op7_best_fit,
    "op8_byte_network": language.op8_byte_network,
    "op9_kneser_ney": toxicity.op9_kneser_ney,
    "op10_prefix_counts": prefixcounts.op10_prefix_counts,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_licenses": licenses.op12_licenses,
    "op13_periodic_runs": periods.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op1_m_tree": mtree.SQL,
    "op2_decontaminate": decontaminate.SQL,
    "op3_ngram_join": ngramjoin.SQL,
    "op11_prefix_trie": prefixtrie.SQL,
}
