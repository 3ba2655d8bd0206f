"""Aggregations.

Everything here is planned as partial + final aggregates, so a hot key sends
one partial row per map task through the shuffle.  Group content (A1) is given
as rows (key, value, multiplicity), never as one list per key: the rows of a
hot key spread over the cluster by value, equal values fold before the
shuffle, and the result has one shape whatever the group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_by_key(df: DataFrame, key: str, value: str, out: str = "n") -> DataFrame:
    """A1 ``GroupByKey``: the content of every group as (key, value, n), ``n``
    being how often the value occurs in the group (NULLs count like values)."""
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias(out))


def group_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """A1 rows form: (key, value, n_in_group) with no list materialised.
    The join back is null-safe, so rows with a NULL key keep their group."""
    counts = (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_in_group"))
                .withColumnRenamed(key, "__gk"))
    return (df.select(key, value)
              .join(counts, F.col(key).eqNullSafe(F.col("__gk")))
              .drop("__gk"))


def all_in_group(df: DataFrame, key, pred: Column, out: str = "ok") -> DataFrame:
    """F10 over groups: whether ``pred`` holds for every row of the key (a
    NULL verdict is skipped, as in ``bool_and``)."""
    return df.groupBy(*_keys(key)).agg(F.bool_and(pred).alias(out))


def combine_per_key_sum(df: DataFrame, key, value: str, out: str = "total") -> DataFrame:
    """A2 ``CombinePerKey(sum)``."""
    return df.groupBy(*_keys(key)).agg(F.sum(value).alias(out))


def concat_lists_rows(df: DataFrame, order: Sequence[str], arr: str,
                      out: str = "item") -> DataFrame:
    """A3 global list concatenation: one row per element with the order
    columns and the position inside its list, so the concatenated sequence is
    ``ORDER BY order..., pos`` and never sits in one row."""
    return df.select(*order, F.posexplode(arr).alias("pos", out))


def count_globally(df: DataFrame, out: str = "n", without_defaults: bool = False) -> DataFrame:
    """A4 ``Count.Globally``: one row, 0 for empty input; ``without_defaults``
    gives no row for empty input."""
    res = df.agg(F.count(F.lit(1)).alias(out))
    return res.filter(F.col(out) > 0) if without_defaults else res


def count_per_element(df: DataFrame, out: str = "n") -> DataFrame:
    """A5 ``Count.PerElement``: count of each distinct row."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(out))


def count_per_key(df: DataFrame, key, out: str = "n") -> DataFrame:
    """A6 ``Count.PerKey``."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias(out))


def mean_globally(df: DataFrame, value: str, out: str = "mean") -> DataFrame:
    """A7 ``Mean.Globally`` (empty input -> NULL)."""
    return df.agg(F.avg(value).alias(out))


def mean_per_key(df: DataFrame, key, value: str, out: str = "mean") -> DataFrame:
    """A7 ``Mean.PerKey``."""
    return df.groupBy(*_keys(key)).agg(F.avg(value).alias(out))


def first_by(order: Sequence, payload: Sequence[str], name: str = "first") -> Column:
    """A8 arg-min: ``min(struct(order..., payload...))``.

    NULL order values sort last (a leading ``isNull`` flag), later order
    columns and the payload break ties, so the pick is deterministic.  This is
    a partial-aggregated min: a hot key costs one partial row per task.
    """
    parts = []
    for i, o in enumerate(order):
        oc = F.col(o) if isinstance(o, str) else o
        parts += [oc.isNull().alias(f"__n{i}"), oc.alias(f"__o{i}")]
    parts += [F.col(p).alias(p) for p in payload]
    return F.min(F.struct(*parts)).alias(name)


def count_non_null(df: DataFrame, key, value: str, out: str = "n") -> DataFrame:
    """A9."""
    return df.groupBy(*_keys(key)).agg(F.count(value).alias(out))


def sum_and_distinct(df: DataFrame, keys, value: str, distinct_of: str,
                     sum_out: str = "total", distinct_out: str = "n_distinct",
                     approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """A10: sum + exact (or approximate, with standard error ``rsd``) distinct
    count per composite key."""
    dc = (F.approx_count_distinct(distinct_of, rsd) if approximate
          else F.count_distinct(distinct_of))
    return df.groupBy(*_keys(keys)).agg(F.sum(value).alias(sum_out), dc.alias(distinct_out))


def conditional_sums(df: DataFrame, key, value: str, cases: dict[str, Column]) -> DataFrame:
    """A11 manual pivot: one column per condition, missing -> 0 (not NULL)."""
    aggs = [F.sum(F.when(cond, _c(value)).otherwise(F.lit(0))).alias(name)
            for name, cond in cases.items()]
    return df.groupBy(*_keys(key)).agg(*aggs)


def distinct_rows(df: DataFrame) -> DataFrame:
    """A16 ``Distinct``."""
    return df.distinct()
