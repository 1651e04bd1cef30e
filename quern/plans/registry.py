"""The named queries of the core: each with its frame and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql.strip()
        return f

    return add


def load() -> None:
    """Import every module of this package that registers queries."""
    import importlib
    import pkgutil

    import quern.plans as here

    for m in pkgutil.iter_modules(here.__path__):
        if m.name != "registry":
            importlib.import_module(f"quern.plans.{m.name}")
