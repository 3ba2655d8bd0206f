"""Filters and predicates and side-input joins.

Predicates are plain ``Column`` conditions so Catalyst can push them into the
parquet scan.  Side inputs that are DataFrames are joined with semi/anti
joins.  No broadcast hint is forced: Catalyst broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-decides from measured shuffle sizes (and splits skewed partitions) when the
estimate is unknown or too large.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_even(col) -> Column:
    """F1."""
    return F.pmod(_c(col), F.lit(2)) == 0


def not_equal(col, value) -> Column:
    """NULL is dropped, as SQL does."""
    return _c(col) != F.lit(value)


def in_literals(col, values: Iterable) -> Column:
    """literal membership."""
    return _c(col).isin(list(values))


def regex_not_match(col, pattern: str) -> Column:
    """rows whose text does **not** match (NULL dropped)."""
    return ~_c(col).rlike(pattern)


def non_empty_after_strip(col) -> Column:
    """``x.strip() != ""``."""
    return T.strip_ws(col) != ""


def longer_than(col, n: int) -> Column:
    """F8."""
    return F.length(_c(col)) > n


def on_date(ts_col, day: str) -> Column:
    """F9 ``DATE(ts) = d``, written as a half-open range so the parquet reader
    receives it as pushed ``>=``/``<`` filters."""
    start = F.to_timestamp_ntz(F.lit(day))
    return (_c(ts_col) >= start) & (_c(ts_col) < F.timestamp_add("DAY", F.lit(1), start))


def all_elements(arr, pred) -> Column:
    """``all(pred(x) for x in arr)``."""
    return F.forall(_c(arr), pred)


def semi_join(df: DataFrame, side: DataFrame, on) -> DataFrame:
    """Keep rows whose key is in the side input."""
    return df.join(side, on=on, how="left_semi")


def anti_join(df: DataFrame, side: DataFrame, on) -> DataFrame:
    """Keep rows whose key is **not** in the side input.

    ``left_anti``, not ``NOT IN``: one NULL on the right would empty NOT IN.
    """
    return df.join(side, on=on, how="left_anti")
