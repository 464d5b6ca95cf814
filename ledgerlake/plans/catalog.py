"""Registered queries: one per operator, each with a DuckDB oracle.

Every query reads the benchmark tables in ``sf_dir`` (whole tables) through
the stand-ins of :mod:`ledgerlake.plans.standins`. The oracle SQL states the
source system's semantics directly (full outer merges, ``IS NOT DISTINCT
FROM`` for null-safe keys, ...) over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from ledgerlake.plans import q_clean, q_fact, q_sources, q_stream, q_upsert, q_versions  # noqa: F401
