"""Set operations, distinct and top-k.

Python set semantics are distinct-valued, so every set operator returns
distinct rows.  Intersection and the differences are one tagged union and one
aggregate: one exchange, with duplicates folded before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """U1 ``Flatten``: duplicates kept, columns matched by name."""
    return a.unionByName(b)


def _by_side(a: DataFrame, b: DataFrame, keep: Column) -> DataFrame:
    """Distinct rows of the tagged union whose sides (``lo`` and ``hi``: 0 for
    ``a``, 1 for ``b``) satisfy ``keep``: duplicates fold before the one
    exchange, NULLs compare equal."""
    cols = a.columns
    tagged = (a.select(*cols, F.lit(0).alias("__side"))
              .unionByName(b.select(*cols, F.lit(1).alias("__side"))))
    return (tagged.groupBy(*cols)
            .agg(F.min("__side").alias("__lo"), F.max("__side").alias("__hi"))
            .filter(keep).select(*cols))


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """U2 ``a & b``: rows on both sides."""
    return _by_side(a, b, F.col("__lo") != F.col("__hi"))


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """U3 ``a | b``."""
    return a.unionByName(b).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4 ``a - b`` (distinct, as Python sets)."""
    return _by_side(a, b, F.col("__hi") == 0)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """U5 ``a ^ b``: rows on exactly one side."""
    return _by_side(a, b, F.col("__lo") == F.col("__hi"))


def distinct_top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """L1: ``SELECT DISTINCT ... ORDER BY ... LIMIT k``.

    Planned as partial/final distinct aggregation feeding a
    TakeOrderedAndProject: each task keeps only its k best rows, no full sort.
    ``order`` should be a total order (add a tie-breaker) for a stable result.
    """
    return df.distinct().orderBy(*order).limit(k)
