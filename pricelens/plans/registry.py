"""Named queries: a DataFrame builder and, where SQL can say it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    inventory: str  # SURVEY ids covered, e.g. "W1 W6 D1"


QUERIES: dict[str, Query] = {}


def register(name: str, inventory: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, inventory)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from pricelens.plans import (  # noqa: F401
        q_aggregates, q_analyses, q_checks, q_clean, q_joins, q_ml, q_scores, q_sources, q_windows,
    )
    return QUERIES
