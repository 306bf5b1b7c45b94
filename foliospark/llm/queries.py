"""The queries of this folder and their SQL, gathered for the driver's entry."""

from __future__ import annotations

import importlib

MODULES = ("encoding_repair", "split", "token_budget", "site_lines", "pair_defects", "scan_repair", "packing", "mixing", "prose_quality")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"{__package__}.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
