"""Queries registered with the driver, and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)``, derives the registry bases from the driver tables in
``sf_dir`` (``sources.registry``) and runs one operator or end-to-end plan over the whole tables.
Each oracle is written directly from the operator's definition in DuckDB SQL, over the same bases
(defined by a ``WITH`` prelude over the driver tables). Column names match one to one.
"""

from __future__ import annotations

from . import api_pages, lists, reports, sources_sinks  # noqa: F401  (importing registers the queries)
from ._registry import ORACLE, QUERIES, register
from .lists import FLAGSHIP_FILTER

__all__ = ["QUERIES", "ORACLE", "register", "FLAGSHIP_FILTER"]
