"""The operators' registered queries, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from changeflow.llm import (
    alignment,
    exact_dedup,
    hard_negatives,
    jaccard,
    line_chunks,
    mixing,
    packing,
    quality,
    simhash,
    suffix_dedup,
    tool_calls,
    topk,
    warc,
)

_MODULES = {
    "op1_warc": warc,
    "op2_jaccard_join": jaccard,
    "op3_exact_dedup": exact_dedup,
    "op4_quality_classifier": quality,
    "op5_line_chunks": line_chunks,
    "op6_tool_calls": tool_calls,
    "op7_suffix_dedup": suffix_dedup,
    "op8_best_fit_packing": packing,
    "op9_mixing": mixing,
    "op10_top_k": topk,
    "op11_alignment": alignment,
    "op12_hard_negatives": hard_negatives,
    "op13_simhash": simhash,
}

QUERIES = {name: module.query for name, module in _MODULES.items()} | {"op5_line_chunks": line_chunks.runs_query}
ORACLE = {name: module.SQL for name, module in _MODULES.items() if hasattr(module, "SQL")}
