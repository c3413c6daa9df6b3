"""All queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glyphflow.plans import catalog_queries, kernel_queries, record_queries, relational_queries

PARTS = (kernel_queries, catalog_queries, relational_queries, record_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for part in PARTS for name, query in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
