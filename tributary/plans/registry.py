"""Registry of named queries: a Spark builder and, where the operator is
expressible in SQL, the equivalent DuckDB query over the same tables.

The two are declared side by side so a reader can check one against the
other.  Spark builders take ``(spark, sf_dir)`` and return a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import table_path

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    survey_ids: tuple[str, ...]
    headline: bool


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ids: tuple[str, ...] = (),
          headline: bool = False):
    """Register ``fn`` under ``name`` with its oracle SQL (``None`` = rows-only)."""
    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql.strip() if sql else None, tuple(ids), headline)
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (parquet; filters and projections push down)."""
    return spark.read.parquet(table_path(sf_dir, name))
