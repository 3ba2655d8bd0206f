"""Stored distinct-count sketches.

An HLL sketch of a group is a small binary value (at most a few kilobytes,
whatever the group holds) that can be stored as a column and merged later: days
to months, months to years, without reading a row again.  Its relative error is
about ``1.04 / sqrt(2^lg_k)``, merged or not; small counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketch size: 2^12 registers, an error of 1.6 %.
LG_K = 12


def store_sketches(df: DataFrame, keys: Sequence[str], value: str, path: str, lg_k: int = LG_K,
                   mode: str = "append") -> DataFrame:
    """Append one sketch per group of ``keys`` to a table: (keys, n_rows,
    sketch).  NULLs are not counted.  Appending a later load adds sketches,
    also of groups that have one already; merging takes them together."""
    known = F.col(value) if dict(df.dtypes)[value] in ("int", "bigint", "string", "binary") else F.col(value).cast("string")
    made = df.groupBy(*keys).agg(F.count(value).alias("n_rows"), F.hll_sketch_agg(known, lg_k).alias("sketch"))
    made.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def merge_sketches(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged sketches per coarser ``keys`` (none: of the whole table), with the
    number of rows and the estimated number of distinct values."""
    merged = stored.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("estimate", F.hll_sketch_estimate("sketch"))
