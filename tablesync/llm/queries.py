"""The queries and the SQL of this subpackage, gathered from its modules."""

from __future__ import annotations

from importlib import import_module

MODULES = ("pitman_yor", "chat_format", "language_id", "multi_index", "mtree", "secret_scan", "mixing", "packing", "ngram_join", "substring_dedup", "collocations", "dual_tree", "token_counts")

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = import_module(f"tablesync.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
