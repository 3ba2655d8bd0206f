"""Row numbers and running frames over a whole table or long groups.

A window without ``PARTITION BY`` puts the whole table in one task, and one
with a hot key puts that key there.  Here the rows are dealt by ranges of
(group, order), so any group spreads over many tasks; each range gives one
total per group, the totals (one row per range and group, never the data) are
summed in order, and every row adds what came before its range to its own
place in it: a distributed prefix scan.

Rows that tie on the whole order are told apart by where they stood in the
input, so a third of all rows may share one order key and still spread.  NULL
group keys are a group; NULLs of the order come where Spark's sort puts them
(first when ascending).  The input is written once to the shared folder (its
row places are then fixed, a lost executor changes nothing) and once more in
order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import discard, materialize

_AT, _TIE, _PART, _FIRST, _BEFORE = "__at", "__tie", "__part", "__first", "__before"

#: Per measure: the aggregate of a range, and how a carried value joins it.
_MEASURES = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + b),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def in_order(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = ()) -> DataFrame:
    """``df`` written in ranges of (``by``, ``order``), with ``__at``: the range
    in the upper bits, the row's place in its range in the lower 33."""
    tied = materialize(df.withColumn(_TIE, F.monotonically_increasing_id()), "ordered-in")
    keys = [*by, *map(_column, order), F.col(_TIE)]
    placed = materialize(tied.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn(_AT, F.monotonically_increasing_id()).drop(_TIE), "ordered")
    discard(tied)
    return placed


def _part() -> Column:
    return F.shiftright(_AT, 33)


def _joined(placed: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each row with its range's row of ``totals``."""
    renamed = totals.withColumnsRenamed({k: f"__by{i}" for i, k in enumerate(by)})
    same = [placed[_PART] == renamed["__p"], *[placed[k].eqNullSafe(renamed[f"__by{i}"]) for i, k in enumerate(by)]]
    return placed.join(renamed, reduce(Column.__and__, same))


def row_numbers(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                out: str = "row_number") -> DataFrame:
    """``out`` = 1, 2, ... without gaps in the given order, over the table
    or per group of ``by``; rows that tie keep the order of the input."""
    placed = in_order(df, order, by).withColumn(_PART, _part())
    totals = placed.groupBy(F.col(_PART).alias("__p"), *by).agg(
        F.min(_AT).alias(_FIRST), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__p", *by, _FIRST, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(_BEFORE))
    return _joined(placed, totals, by).select(
        *df.columns, (F.col(_AT) - F.col(_FIRST) + F.col(_BEFORE) + 1).alias(out))


def running(df: DataFrame, order: Sequence[str | Column], measures: Mapping[str, tuple[str, str]],
            by: Sequence[str] = ()) -> DataFrame:
    """Running measures, ``{out: (kind, column)}`` with ``kind`` one of
    sum, count, min, max and avg, over all rows up to and with this one
    (``ROWS UNBOUNDED PRECEDING``).  NULLs are left out as SQL aggregates do;
    sums of decimals and integers do not depend on how the rows were dealt, an
    average is the double nearest to such a sum, divided by the count."""
    wanted: dict[str, tuple[str, str]] = {}
    for out, (kind, column) in measures.items():
        wanted |= ({f"__s_{out}": ("sum", column), f"__c_{out}": ("count", column)} if kind == "avg"
                   else {f"__m_{out}": (kind, column)})
    placed = in_order(df, order, by).withColumn(_PART, _part())
    totals = placed.groupBy(F.col(_PART).alias("__p"), *by).agg(
        *[_MEASURES[kind][0](column).alias(f"{m}_t") for m, (kind, column) in wanted.items()])
    earlier = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)

    def carried(kind: str, total: str) -> Column:
        return (F.sum if kind in ("sum", "count") else _MEASURES[kind][0])(total).over(earlier)

    totals = totals.select("__p", *by, *[carried(kind, f"{m}_t").alias(f"{m}_b") for m, (kind, _) in wanted.items()])
    inside = Window.partitionBy(_PART, *by).orderBy(_AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumns({m: _MEASURES[kind][0](column).over(inside) for m, (kind, column) in wanted.items()})
    joined = _joined(local, totals, by)
    done = {m: _MEASURES[kind][1](F.col(f"{m}_b"), F.col(m)) for m, (kind, _) in wanted.items()}

    def result(out: str, kind: str) -> Column:
        if kind == "avg":
            return F.try_divide(done[f"__s_{out}"].cast("double"), done[f"__c_{out}"]).alias(out)
        return done[f"__m_{out}"].alias(out)

    return joined.select(*[F.col(c) for c in df.columns], *[result(out, kind) for out, (kind, _) in measures.items()])
