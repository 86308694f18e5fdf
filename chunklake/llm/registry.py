"""The queries of the training-data operators, and SQL for those that have it."""

from __future__ import annotations

import importlib

MODULES = (
    "filter_audit",
    "hnsw",
    "license_scan",
    "line_dedup",
    "lz_fingerprint",
    "mixing",
    "packing",
    "pii",
    "simhash_dedup",
    "substring_dedup",
    "toxicity",
    "url_filter",
    "vector_codes",
)

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"chunklake.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.ORACLE_SQL
