"""Queries of this subpackage, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from tillroll.llm.alignment import op13_cross_tokenizer_alignment
from tillroll.llm.audit import OP11_SQL, op11_filter_interaction_audit
from tillroll.llm.chaining import op8_collinear_chaining
from tillroll.llm.cotraining import op7_cotraining_quality
from tillroll.llm.embeddings import OP2_SQL, op2_int8_near_dedup
from tillroll.llm.fingerprints import op3_lempel_ziv_fingerprints
from tillroll.llm.linededup import OP4_SQL, op4_cuckoo_line_dedup
from tillroll.llm.mixing import OP9_SQL, op9_hierarchical_mixing
from tillroll.llm.packing import op6_vector_best_fit_packing
from tillroll.llm.secrets import op1_markov_secret_scan
from tillroll.llm.setsketch import OP5_SQL, op5_setsketch_near_dedup
from tillroll.llm.sharding import op10_hypergeometric_sharding
from tillroll.llm.topk import OP12_SQL, op12_exact_topk_search

QUERIES = {
    f.__name__: f
    for f in (
        op1_markov_secret_scan,
        op2_int8_near_dedup,
        op3_lempel_ziv_fingerprints,
        op4_cuckoo_line_dedup,
        op5_setsketch_near_dedup,
        op6_vector_best_fit_packing,
        op7_cotraining_quality,
        op8_collinear_chaining,
        op9_hierarchical_mixing,
        op10_hypergeometric_sharding,
        op11_filter_interaction_audit,
        op12_exact_topk_search,
        op13_cross_tokenizer_alignment,
    )
}
ORACLE = {
    "op2_int8_near_dedup": OP2_SQL,
    "op4_cuckoo_line_dedup": OP4_SQL,
    "op5_setsketch_near_dedup": OP5_SQL,
    "op9_hierarchical_mixing": OP9_SQL,
    "op11_filter_interaction_audit": OP11_SQL,
    "op12_exact_topk_search": OP12_SQL,
}
