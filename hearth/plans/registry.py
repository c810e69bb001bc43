"""Registry of named queries: a Spark builder plus, where SQL can say it, a DuckDB oracle.

``__spark_entry__.py`` exposes this registry to the driver. Oracle SQL is
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixture_sql import with_views

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...] = field(default_factory=tuple)
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, *ids: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, with_views(sql) if sql else None, ids,
                               (fn.__doc__ or "").strip())
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from . import catalog  # noqa: F401
    return REGISTRY
