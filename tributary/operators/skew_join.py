"""Full outer joins with hot keys on both sides.

Spark splits skewed partitions of inner, left and right joins, but not of a
full outer one: a split row could not know whether another split matched it.
With one key a row has a match exactly if the other side has the key at all, so
the hot keys can be treated apart:

* a mergeable frequency sketch over both sides (fixed size, one pass) names the
  keys that may hold more than a share of the rows; the names are counted
  exactly, and those that do hold it are hot (at most ``1 / share`` a side);
* rows of a hot key that the other side lacks, and rows with a null key, which
  match nothing, go straight to the result;
* rows of a hot key that both sides have are dealt over a grid of ``rows x
  columns`` cells: a left row goes to every cell of a random grid row, a right
  row to every cell of a random column, and each pair of rows meets in one cell.
  The grid is shaped by the counts, so that a side with one row per key is
  copied and the other is not;
* all other rows are joined as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: A key with at least this share of a side's rows is hot.
SHARE = 0.01
#: Most cells of one key's grid along either side.
GRID = 64


def hot_keys(left: DataFrame, right: DataFrame, key: str, share: float = SHARE) -> list:
    """(key, rows on the left, rows on the right) of the keys that hold at least
    ``share`` of a side's rows; nulls are never hot.  At most ``2 / share``."""
    tracked = max(100, round(4 / share))

    def candidates(side: DataFrame) -> DataFrame:
        top = side.where(F.col(key).isNotNull()).agg(
            F.expr(f"approx_top_k(`{key}`, {min(10_000, round(2 / share))}, {max(tracked, 2 * round(2 / share))})").alias("t"))
        return top.select(F.inline("t")).select(F.col("item").alias(key))

    named = candidates(left).unionByName(candidates(right)).distinct()
    many = None
    for side, name in ((left, "l"), (right, "r")):
        own = side.join(F.broadcast(named), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias(name))
        many = own if many is None else many.join(own, key, "full_outer")
    n_left, n_right = left.count(), right.count()
    hot = many.select(key, F.coalesce("l", F.lit(0)).alias("l"), F.coalesce("r", F.lit(0)).alias("r")).where(
        (F.col("l") >= max(2, share * n_left)) | (F.col("r") >= max(2, share * n_right)))
    return hot.limit(2 * round(1 / share) + 2).collect()  # no more keys can hold that share of a side


def grid(l: int, r: int, cells: int) -> tuple[int, int]:  # noqa: E741
    """Rows and columns of a grid of about ``cells`` cells for ``l`` x ``r``
    pairs that copies as few rows as it can (l * columns + r * rows)."""
    rows = min(GRID, max(1, round((cells * l / max(1, r)) ** 0.5)), max(1, l))
    return rows, min(GRID, max(1, cells // rows), max(1, r))


def full_outer_skewed(left: DataFrame, right: DataFrame, key: str, share: float = SHARE,
                      cells: int | None = None) -> DataFrame:
    """``left`` full outer join ``right`` on ``key``: the key once, then the
    other columns of both sides (whose names must differ).  ``cells`` is how
    many tasks a hot key is dealt over (default: the shuffle partitions)."""
    spark = left.sparkSession
    cells = cells or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [c for c in left.columns if c != key]
    other = [c for c in right.columns if c != key]
    left, right = (materialize(side, "outer-side") for side in (left, right))
    hot = hot_keys(left, right, key, share)
    nowhere = left.where(F.col(key).isNull()).select(key, *own).unionByName(
        right.where(F.col(key).isNull()).select(key, *other), allowMissingColumns=True)
    left, right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    if not hot:
        return left.join(right, key, "full_outer").select(key, *own, *other).unionByName(nowhere)

    shapes = {h[key]: grid(h.l, h.r, cells) for h in hot}
    kind = left.schema[key].dataType
    plan = spark.createDataFrame([(h[key], h.l > 0 and h.r > 0, *shapes[h[key]]) for h in hot],
                                 f"`{key}` {kind.simpleString()}, __both boolean, __rows int, __cols int")

    def deal(side: DataFrame, names: list[str], fixed: str, free: str, place: str, every: str) -> DataFrame:
        """A random place along one side of the grid, drawn once a row; every place along the other."""
        drawn = side.select(key, *names, free, (F.rand(7) * F.col(fixed)).cast("int").alias(place))
        return drawn.select(key, *names, place, F.explode(F.sequence(F.lit(0), F.col(free) - 1)).alias(every))

    marked = [side.join(F.broadcast(plan), key, "left") for side in (left, right)]
    cold = [side.where("__both is null").drop("__both", "__rows", "__cols") for side in marked]
    both = [side.where("__both") for side in marked]
    alone = [side.where("not __both") for side in marked]
    dealt_left = deal(both[0], own, "__rows", "__cols", "__r", "__c")
    dealt_right = deal(both[1], other, "__cols", "__rows", "__c", "__r")
    # written: a random place must not change when a lost task runs again
    dealt_left, dealt_right = materialize(dealt_left, "outer-left"), materialize(dealt_right, "outer-right")
    met = dealt_left.join(dealt_right, [key, "__r", "__c"]).select(key, *own, *other)
    return (cold[0].join(cold[1], key, "full_outer").select(key, *own, *other)
            .unionByName(met)
            .unionByName(alone[0].select(key, *own), allowMissingColumns=True)
            .unionByName(alone[1].select(key, *other), allowMissingColumns=True)
            .unionByName(nowhere, allowMissingColumns=True))
