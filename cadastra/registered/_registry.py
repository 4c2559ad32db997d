"""Query registry: the driver-facing dictionaries and the decorator that fills them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.registry import oracle_prelude

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` (DuckDB, after the registry prelude) is its oracle."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = oracle_prelude() + sql
        return fn
    return deco
