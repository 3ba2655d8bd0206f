"""Projections and row transforms.

Every operator takes a DataFrame plus column names and returns a DataFrame
built from built-in expressions: Catalyst prunes columns and pushes filters
through them to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_length(df: DataFrame, col: str, out: str = "length", keep: list[str] | None = None) -> DataFrame:
    """P1 ``Map(len)``."""
    return df.select(*(keep or []), F.length(_c(col)).alias(out))


def flat_map_split(df: DataFrame, col: str, delimiter: str = ",", out: str = "item",
                   keep: list[str] | None = None, with_position: bool = False) -> DataFrame:
    """P2 ``FlatMap(str.split)``: one row per piece, literal delimiter."""
    parts = T.split_on(col, delimiter)
    if with_position:
        return df.select(*(keep or []), F.posexplode(parts).alias("pos", out))
    return df.select(*(keep or []), F.explode(parts).alias(out))


def flatten_list(df: DataFrame, col: str, out: str = "item",
                 keep: list[str] | None = None) -> DataFrame:
    """P2 identity ``FlatMap`` of a list column."""
    return df.select(*(keep or []), F.explode(_c(col)).alias(out))


def word_lengths(df: DataFrame, col: str, delimiter: str, word: str = "word",
                 length: str = "length", keep: list[str] | None = None) -> DataFrame:
    """P3 ``ParDo`` with a constructor parameter: (word, len(word)) per piece."""
    return (flat_map_split(df, col, delimiter, out=word, keep=keep, with_position=True)
            .withColumn(length, F.length(F.col(word))))


def tokens(df: DataFrame, col: str, delimiter: str | None = " ", out: str = "word",
           keep: list[str] | None = None, with_position: bool = True) -> DataFrame:
    """P4 null-safe tokeniser: NULL text yields no rows (the reference logs
    and drops).  ``delimiter=None`` splits on whitespace runs like ``split()``.
    With ``with_position`` each piece carries its 0-based position."""
    parts = T.split_ws(col) if delimiter is None else T.split_on(col, delimiter)
    src = df.filter(_c(col).isNotNull())
    if with_position:
        return src.select(*(keep or []), F.posexplode(parts).alias("pos", out))
    return src.select(*(keep or []), F.explode(parts).alias(out))


def keys(df: DataFrame, k: str = "k") -> DataFrame:
    """P7 ``Keys``."""
    return df.select(F.col(k).alias("k"))


def values(df: DataFrame, v: str = "v") -> DataFrame:
    """P8 ``Values``."""
    return df.select(F.col(v).alias("v"))


def kv_swap(df: DataFrame, k: str = "k", v: str = "v") -> DataFrame:
    """P9 ``KvSwap``."""
    return df.select(F.col(v).alias("k"), F.col(k).alias("v"))


def with_branch(df: DataFrame, branch: Column, name: str = "branch") -> DataFrame:
    """The branch number is a column computed once."""
    return df.withColumn(name, branch)


def partition(df: DataFrame, branch: Column, n: int, name: str = "branch") -> dict[int, DataFrame]:
    """P19 ``Partition(fn, n)``: n lazily filtered frames over one branch column,
    plus key ``-1`` for rows whose branch is NULL or outside ``[0, n)`` (so no
    row is lost; check that frame where such rows are an error).

    The parent is not re-computed per branch only if the caller persists it;
    for one pass over all branches use :func:`with_branch` and ``groupBy``.
    """
    tagged = with_branch(df, branch, name)
    b = F.col(name)
    out = {i: tagged.filter(b == i).drop(name) for i in range(n)}
    out[-1] = tagged.filter(b.isNull() | (b < 0) | (b >= n)).drop(name)
    return out


def parity_branch(col) -> Column:
    """P19 ``len(x) % 2``-style branch of an integer expression."""
    return F.pmod(_c(col), F.lit(2)).cast("int")


def age_band(col) -> Column:
    """P19 band function.  Fixed values (edges kept exactly as the reference):
    age < 20 -> 0; 21 < age < 41 -> 1; 41 < age < 56 -> 2; anything else -> 3
    (so 20, 21, 41 and >= 56 fall to 3)."""
    c = _c(col)
    return (F.when(c < 20, 0)
             .when((c > 21) & (c < 41), 1)
             .when((c > 41) & (c < 56), 2)
             .otherwise(3))


def length_band_filter(df: DataFrame, col: str, min_len: int, max_len: int) -> DataFrame:
    """P20 side input as arguments: ``min_len < len(x) < max_len``."""
    n = F.length(_c(col))
    return df.filter((n > min_len) & (n < max_len))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """P11."""
    return df.withColumnRenamed(old, new)


def signed_value(side, amount, positive: str = "Buy") -> Column:
    """``CASE WHEN side = positive THEN amount ELSE -amount END``."""
    return F.when(_c(side) == positive, _c(amount)).otherwise(-_c(amount))


def scaled(col, factor) -> Column:
    """Multiply by a captured constant."""
    return _c(col) * F.lit(factor)
