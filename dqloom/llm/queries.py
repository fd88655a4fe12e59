"""The registered queries of this subpackage: opN_<name>(spark, sf_dir), and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

#: query, module, function, name of its SQL in that module (or none)
_LIST = [
    ("op1_pii", "pii", "op1", None),
    ("op2_ngram_join", "ngram_join", "op2", "OP2_SQL"),
    ("op3_toxicity", "toxicity", "op3", None),
    ("op4_mixing", "mixing", "op4", None),
    ("op5_html_text", "html_text", "op5", None),
    ("op6_chat", "chat", "op6", None),
    ("op7_nearest", "vp_search", "op7", None),
    ("op8_packing", "packing", "op8", None),
    ("op9_exact_dedup", "exact_dedup", "op9", "OP9_SQL"),
    ("op10_language_id", "language_id", "op10", None),
    ("op11_prefix_trie", "prefix_trie", "op11", None),
    ("op12_substring_dedup", "substring_dedup", "op12", "OP12_SQL"),
    ("op13_spelling", "spelling", "op13", None),
]


def queries() -> dict[str, Callable]:
    return {name: getattr(import_module(f"dqloom.llm.{module}"), function) for name, module, function, _ in _LIST}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"dqloom.llm.{module}"), sql) for name, module, _, sql in _LIST if sql}
