"""Registered queries of the reference's operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    """Decorator: adds a (spark, sf_dir) query and its SQL, where there is one."""

    def add(f):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = (f, sql)
        return f

    return add


def _loaded() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    from brontide.plans import registered, registered_sources  # noqa: F401  they register on import

    return _QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _loaded().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _loaded().items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brontide.plans import registered

    return registered.flagship(spark, sf_dir)
