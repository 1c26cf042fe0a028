"""Registered queries: name → (Spark builder, DuckDB oracle SQL or None).

Each Spark builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver tables; every float that leaves a query goes through ``round6`` on
both sides so the value hashes are engine-independent.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all():
    """Import the modules that register queries (idempotent)."""
    from . import queries_detector, queries_profile, queries_split, queries_model  # noqa: F401
    return QUERIES, ORACLES
