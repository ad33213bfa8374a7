"""Registered queries over the given tables, each beside its DuckDB oracle."""

from __future__ import annotations

from importlib import import_module
from typing import NamedTuple

_MODULES = ("ingest", "clinic", "operations", "changes", "models", "streams", "reports")


class Catalog(NamedTuple):
    queries: dict
    oracles: dict


def load() -> Catalog:
    for name in _MODULES:
        import_module(f"wardspark.catalog.{name}")
    registry = import_module("wardspark.catalog.registry")
    return Catalog(registry.QUERIES, registry.ORACLES)
