"""Queries of the training-data operators over the sample tables."""

from __future__ import annotations

from kasir.llm.bpe_tree import op7_bpe_tree
from kasir.llm.centroids import OP12_SQL, op12_centroids
from kasir.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from kasir.llm.graph_index import op13_graph_neighbours
from kasir.llm.language import op6_language
from kasir.llm.line_dedup import OP3_SQL, op3_line_dedup
from kasir.llm.merkle import OP11_SQL, op11_merkle_manifest
from kasir.llm.ngram_join import OP9_SQL, op9_ngram_join
from kasir.llm.packing import op5_packing
from kasir.llm.quality import op2_quality
from kasir.llm.token_store import op1_token_files
from kasir.llm.topk import OP4_SQL, op4_top_k
from kasir.llm.url_rules import op8_url_rules

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_top_k": op4_top_k,
    "op5_packing": op5_packing,
    "op6_language": op6_language,
    "op7_bpe_tree": op7_bpe_tree,
    "op8_url_rules": op8_url_rules,
    "op9_ngram_join": op9_ngram_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_centroids": op12_centroids,
    "op13_graph_neighbours": op13_graph_neighbours,
}

ORACLES = {
    "op3_line_dedup": OP3_SQL,
    "op4_top_k": OP4_SQL,
    "op9_ngram_join": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_centroids": OP12_SQL,
}
