"""Queries and their oracles, gathered as modules define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attesta.plans.store import Store, with_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of a Store; ``sql`` is DuckDB SQL over s_<store table> and driver tables."""

    def add(f: Callable[[Store], DataFrame]):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: f(Store(spark, sf_dir))
        if sql:
            ORACLE_SQL[key] = with_store(sql)
        return f

    return add
