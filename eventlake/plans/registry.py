"""Where the registered queries and their oracles are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlake.plans.ctes import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function; `sql` may use the derived tables."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = oracle(sql)
        return f

    return keep
