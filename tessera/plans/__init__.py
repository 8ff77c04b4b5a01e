"""Queries bound to the driver's tables, and their DuckDB oracle SQL.

Each module exposes QUERIES (name -> callable(spark, sf_dir) -> DataFrame) and
ORACLE (name -> SQL over the tables registered as views).  A query without an
ORACLE entry is checked on row counts only (and against brute force in tests).
"""

from __future__ import annotations

import importlib

MODULES = ["funds", "basic", "text", "search", "report", "changes", "pages"]


def registry():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"tessera.plans.{m}")
        for k in mod.QUERIES:
            if k in queries:
                raise ValueError(f"duplicate query {k}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle
