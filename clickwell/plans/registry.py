"""Query registry: every operator exposed as ``(spark, sf_dir) -> DataFrame`` plus its
DuckDB oracle SQL (``None`` where the result is not SQL-expressible and only a
row-count check applies).  ``__spark_entry__`` re-exports these two dicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str | None] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    from . import (queries_clean, queries_decide, queries_experiment, queries_explore, queries_forecast,  # noqa: F401
                   queries_kpi, queries_profile, queries_quality, queries_stream, queries_tables,
                   queries_time)
