"""Where queries and their oracles are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from wardspark.catalog.domain import Domain, Query, query
from wardspark.catalog.oracle import with_tables

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, tables: str = "") -> Callable:
    """Register a function of the domain; ``sql`` is its oracle over the named domain tables."""

    def add(build: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
        QUERIES[name] = query(build)
        if sql is not None:
            ORACLES[name] = with_tables(tables, sql) if tables else sql.strip()
        return build

    return add
