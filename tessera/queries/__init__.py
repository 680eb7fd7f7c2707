"""Registered queries: one per operator / pipeline of the inventory.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` reading the driver
tables; most carry an equivalent SQL text for an independent engine
(DuckDB) so results can be compared value by value.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    headline: bool = False


REGISTRY: dict[str, Query] = {}

MODULES = ("retail", "sources", "sinks", "projections", "filters", "cleaning",
           "sorting", "joins", "aggregates", "windows", "dates", "strings",
           "maths", "arrays", "ml", "layout", "sql", "pipelines", "text",
           "quotes", "synth")


def register(name: str, sql: str | None = None, headline: bool = False):
    """Decorator: register ``fn`` as query ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql, headline)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    for mod in MODULES:
        try:
            importlib.import_module(f"tessera.queries.{mod}")
        except ModuleNotFoundError as exc:
            if exc.name != f"tessera.queries.{mod}":
                raise
    return REGISTRY
