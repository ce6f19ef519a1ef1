"""Registered queries over the test tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = ("expressions", "dedupe", "quality", "joins", "writes", "text", "files", "jobs", "flows")
_REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in _REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return add


def registry() -> dict[str, tuple[Query, str | None]]:
    for module in _MODULES:
        import_module(f"rowmill.queries.{module}")
    return dict(_REGISTRY)
