"""Registry of the queries over the shared test tables.

Each entry pairs a Spark builder ``fn(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that states the same result independently (the oracle).  Entries
without SQL are checked by row count only and, in ``tests/``, against a
brute-force computation on a small fixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def load_all():
    """Import every query module (registration happens at import)."""
    from . import (cleaning_queries, consolidated_queries, dedup_queries, earnings_queries,  # noqa: F401
                   people_queries, quality_queries, report_queries, template_queries)
    return QUERIES, ORACLE
