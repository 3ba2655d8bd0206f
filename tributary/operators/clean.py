"""Cleaning of dirty tables.

Column-name rules run on the driver over ``df.columns`` (metadata only, no
rows).  Content rules are aggregate jobs: column typing looks at every string
column in **one** aggregate pass, and whole-table fill values are scalar
subqueries, never an unpartitioned window.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def sanitize_name(name: str) -> str:
    """Every non-word character -> ``_``, then ``_`` trimmed at both ends."""
    return re.sub(r"[^\w]", "_", name).strip("_")


def sanitize_column_names(df: DataFrame) -> DataFrame:
    """P12 over all columns; two names that collide after cleaning fail."""
    new = [sanitize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both become {n!r}")
        seen[n] = old
    return df.toDF(*new)


def is_unnamed(name: str) -> bool:
    """A column that came from an empty header cell.

    Spark names such a column ``_c<N>``; pandas names it ``Unnamed: N``.
    """
    return bool(re.fullmatch(r"_c\d+", name)) or "Unnamed" in name


def drop_unnamed(df: DataFrame) -> DataFrame:
    """P13."""
    return df.drop(*[c for c in df.columns if is_unnamed(c)])


_INT_TEXT = r"^\s*[-+]?[0-9]+\s*$"


def numeric_columns(df: DataFrame, decimal_comma: bool = True) -> DataFrame:
    """Per string column, ``,`` -> ``.``, and convert the **whole** column to
    a number only if every non-NULL value converts; otherwise keep the fixed
    strings.  All integer text that fits -> bigint, other numbers -> double; a
    column without any value stays text.

    One aggregate job counts, for every string column at once, the values that
    are not numbers, those that are not integers, and integers beyond bigint.
    """
    str_cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    fixed = {c: (F.replace(F.col(c), F.lit(","), F.lit(".")) if decimal_comma else F.col(c))
             for c in str_cols}
    if not str_cols:
        return df
    probes = []
    for i, c in enumerate(str_cols):
        v = fixed[c]
        probes.append(F.count(v).alias(f"n{i}"))
        probes.append(F.count_if(v.isNotNull() & ~T.number_text_ok(v)).alias(f"b{i}"))
        probes.append(F.count_if(v.isNotNull() & ~v.rlike(_INT_TEXT)).alias(f"f{i}"))
        probes.append(F.count_if(v.rlike(_INT_TEXT) & F.trim(v).try_cast("bigint").isNull())
                      .alias(f"o{i}"))
    stats = df.agg(*probes).first()
    out = []
    for f in df.schema.fields:
        c = f.name
        if c not in fixed:
            out.append(F.col(c))
            continue
        i = str_cols.index(c)
        if stats[f"n{i}"] > 0 and stats[f"b{i}"] == 0:
            target = "bigint" if stats[f"f{i}"] == 0 and stats[f"o{i}"] == 0 else "double"
            out.append(F.trim(fixed[c]).cast(target).alias(c))
        else:
            out.append(fixed[c].alias(c))
    return df.select(*out)


def with_processed_at(df: DataFrame, name: str = "processed_timestamp", at: Column | None = None) -> DataFrame:
    """One processing timestamp per query (``at`` instead of the clock's)."""
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def is_json_object(col) -> Column:
    """Whether the text is a JSON object (NULL text: NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c).isNotNull() & c.rlike(r"^\s*\{")


def json_valid_rejects(df: DataFrame, col: str, schema: str,
                       parsed: str = "parsed") -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid parsed, rejects).

    Valid is a JSON object; a number, an array, damaged text and NULL are
    rejects.  Valid rows get the typed fields of ``schema``.  Both frames come from the
    same plan: persist the input if both are consumed.
    """
    ok = is_json_object(col)
    valid = df.filter(ok).withColumn(parsed, F.from_json(F.col(col), schema))
    rejects = df.filter(~ok | F.col(col).isNull())
    return valid, rejects


def fill_null_constant(df: DataFrame, col: str, value) -> DataFrame:
    """W3 ``when(isNull, value)``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def exact_avg(col) -> Column:
    """Average over decimals: the same whatever the order of summation, so a
    truncation to int after it cannot move."""
    return F.avg(F.col(col).cast("decimal(28,8)"))


def fill_null_with_avg(df: DataFrame, col: str, as_written: bool = False,
                       cast: str = "int") -> DataFrame:
    """NULL -> whole-table average, truncated to ``cast``.

    Default is the stated aim (average of the non-NULL values).  ``as_written``
    reproduces the reference job: NULL -> 0 first, the average includes those
    zeros, and every 0 (real ones too) is replaced.

    The average is a scalar subquery: one aggregate job whose single value is
    inlined, instead of a window with no partition (which moves every row into
    one task) or a cross join.
    """
    if as_written:
        zeroed = df.withColumn(col, F.coalesce(F.col(col), F.lit(0)))
        avg_val = zeroed.select(exact_avg(col)).scalar()
        return zeroed.withColumn(col, F.when(F.col(col) == 0, avg_val.cast(cast))
                                 .otherwise(F.col(col).cast(cast)))
    avg_val = df.select(exact_avg(col)).scalar()
    return df.withColumn(col, F.coalesce(F.col(col).cast(cast), avg_val.cast(cast)))


def fill_null_with_group_avg(df: DataFrame, col: str, key: str, cast: str = "int") -> DataFrame:
    """NULL -> average of its key.

    The per-key averages are a partial-aggregated ``groupBy`` joined back on the
    key, rather than a window partitioned by the key, which would place a hot
    key in a single task.  Spark broadcasts the averages when their measured
    size allows; else it is a shuffle join whose skewed partitions AQE splits.
    """
    avgs = df.groupBy(F.col(key).alias("__gk")).agg(exact_avg(col).cast(cast).alias("__group_avg"))
    joined = df.join(avgs, F.col(key).eqNullSafe(F.col("__gk")), "left").drop("__gk")
    return (joined.withColumn(col, F.coalesce(F.col(col).cast(cast), F.col("__group_avg")))
                  .drop("__group_avg")
                  .select(*df.columns))


def nullify(col, cond: Column) -> Column:
    """Inject NULLs where ``cond`` holds (used to build dirty test inputs)."""
    return F.when(cond, F.lit(None)).otherwise(F.col(col) if isinstance(col, str) else col)
