"""The queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import importlib

MODULES = ("toxicity", "ngram_join", "packing", "secrets", "chat", "licenses", "quality", "line_dedup", "mixing", "media")

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = importlib.import_module(f"inkstrata.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
