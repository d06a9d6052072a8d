"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(*tables: str, sql: str | None = None, name: str | None = None):
    """Registers a function of tables; ``sql`` computes the same from the same tables."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(*(table(spark, sf_dir, t) for t in tables))
        if sql:
            ORACLES[key] = sql
        return f

    return register
