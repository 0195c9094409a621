"""Registry of named queries (one per inventory item) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is the DuckDB oracle (None when
    the operator has no SQL equivalent, e.g. file streams)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from lakeops.plans import core, quality, landing, marts  # noqa: F401
