"""Registered queries over the driver's tables (with DuckDB oracles)."""

from rowsieve.catalog.queries import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
