"""Import every query module so the registry is complete."""

from __future__ import annotations

from . import q_aggregates, q_hooks, q_io, q_jobs, q_ordered, q_regex, q_rows, q_streams, q_windows  # noqa: F401
from .registry import QUERIES, Query

__all__ = ["QUERIES", "Query", "all_queries", "oracle_sql"]


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {n: q.sql for n, q in QUERIES.items() if q.sql}
