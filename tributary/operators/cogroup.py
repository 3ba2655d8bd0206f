"""Co-grouping.

``CoGroupByKey`` is a full-outer grouping of two keyed inputs.  Both inputs are
tagged and their union is aggregated once by (key, side, value): one exchange,
equal values fold before it, a hot key spreads by value, and the result has
one shape whatever the group size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cogroup(left: DataFrame, right: DataFrame, key: str,
            left_value: str, right_value: str) -> DataFrame:
    """The content of both sides of every key as (key, side, value, n),
    ``n`` being how often the value occurs on that side.  Values keep their
    type when both sides share it, else become strings; an absent side has no
    row; NULL keys form a group and NULL values count."""
    rows = cogroup_rows(left, right, key, left_value, right_value)
    return rows.groupBy(key, "side", "value").agg(F.count(F.lit(1)).alias("n"))


def cogroup_rows(left: DataFrame, right: DataFrame, key: str,
                 left_value: str, right_value: str) -> DataFrame:
    """J1 rows form: (key, side, value) -- the co-group without any list."""
    lt, rt = left.schema[left_value].dataType, right.schema[right_value].dataType
    vtype = lt.simpleString() if lt == rt else "string"
    return (left.select(F.col(key), F.lit("left").alias("side"),
                        F.col(left_value).cast(vtype).alias("value"))
            .unionByName(right.select(F.col(key), F.lit("right").alias("side"),
                                      F.col(right_value).cast(vtype).alias("value"))))


def named_aggregates(df: DataFrame, key: str, **named) -> DataFrame:
    """Several aggregates of one input met by key = one ``groupBy().agg()``
    (one scan, one exchange) instead of two aggregates joined back."""
    return df.groupBy(key).agg(*[c.alias(n) for n, c in named.items()])


def full_outer_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """J2 general form: two independently keyed inputs, full-outer on the key."""
    return left.join(right, on=key, how="full_outer")
