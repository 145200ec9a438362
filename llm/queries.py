"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from llm import (op1_sharding, op2_quality, op3_mixing, op4_language, op5_packing, op6_chat, op7_neardup, op8_nearest,
                 op9_html, op10_substrings, op11_runs, op12_license, op13_search)

QUERIES = {
    "op1_sharding": op1_sharding.op1_sharding,
    "op2_quality": op2_quality.op2_quality,
    "op3_mixing": op3_mixing.op3_mixing,
    "op4_language": op4_language.op4_language,
    "op5_packing": op5_packing.op5_packing,
    "op6_chat": op6_chat.op6_chat,
    "op7_neardup": op7_neardup.op7_neardup,
    "op8_nearest": op8_nearest.op8_nearest,
    "op9_html": op9_html.op9_html,
    "op10_substrings": op10_substrings.op10_substrings,
    "op11_runs": op11_runs.op11_runs,
    "op12_license": op12_license.op12_license,
    "op13_search": op13_search.op13_search,
}

ORACLE = {
    "op1_sharding": op1_sharding.ORACLE_SQL,
    "op2_quality": op2_quality.ORACLE_SQL,
    "op6_chat": op6_chat.ORACLE_SQL,
    "op7_neardup": op7_neardup.ORACLE_SQL,
    "op8_nearest": op8_nearest.ORACLE_SQL,
    "op10_substrings": op10_substrings.ORACLE_SQL,
    "op11_runs": op11_runs.ORACLE_SQL,
    "op12_license": op12_license.ORACLE_SQL,
    "op13_search": op13_search.ORACLE_SQL,
}
