"""Event-time windows in batch form.

Fixed and sliding windows are Spark's ``window`` grouping (sliding windows are
expanded per event, then partially aggregated).  Sessions use a two-phase plan
so that neither a global session line nor a hot key lands in one task:

1. bucket events by ``floor(ts / gap)`` and pre-aggregate each
   (key, bucket) to (first, last, count).  Two events in one bucket are less
   than one gap apart, so a bucket never splits across sessions;
2. run the gap logic (``lag`` + running sum) over the buckets only, block by
   block in parallel, then stitch the blocks (see ``sessions_from_buckets``).

The merge edge follows Spark's ``session_window``: an event exactly one gap
after the previous one joins its session.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _micros(df: DataFrame, ts: str) -> Column:
    """Epoch micros of a TIMESTAMP or TIMESTAMP_NTZ column, zone-free."""
    dtype = df.schema[ts].dataType.simpleString()
    return T.epoch_micros_ntz(ts) if dtype == "timestamp_ntz" else F.unix_micros(F.col(ts))


def _from_micros(df: DataFrame, ts: str, micros: Column) -> Column:
    dtype = df.schema[ts].dataType.simpleString()
    if dtype == "timestamp_ntz":
        return F.timestamp_add("MICROSECOND", micros, F.expr(T.EPOCH_NTZ))
    return F.timestamp_micros(micros)


def _window_agg(df: DataFrame, window: Column, keys: Sequence[str],
                aggs: dict[str, Column] | None) -> DataFrame:
    aggs = aggs or {"n": F.count(F.lit(1))}
    return (df.groupBy(*keys, window.alias("w"))
              .agg(*[c.alias(n) for n, c in aggs.items()])
              .select(*keys, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), *aggs.keys()))


def fixed_windows(df: DataFrame, ts: str, size: str, keys: Sequence[str] = (),
                  aggs: dict[str, Column] | None = None) -> DataFrame:
    """Tumbling windows; no row for an empty window."""
    return _window_agg(df, F.window(ts, size), keys, aggs)


def sliding_windows(df: DataFrame, ts: str, size: str, slide: str,
                    keys: Sequence[str] = (), aggs: dict[str, Column] | None = None) -> DataFrame:
    """Hopping windows of ``size`` every ``slide``."""
    return _window_agg(df, F.window(ts, size, slide), keys, aggs)


#: How the partial results of panes add up to a window's.
_PANE_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def sliding_by_panes(df: DataFrame, ts: str, size_seconds: int, slide_seconds: int, keys: Sequence[str] = (),
                     aggs: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """T3 by shared panes: the same rows as ``sliding_windows``.

    A pane is ``gcd(size, slide)`` long, so every window is made of whole panes.
    Rows are aggregated once, per pane; each pane, not each row, is copied to
    its ``size / slide`` windows.  ``aggs`` is ``{out: (kind, column)}`` with
    kind count, sum, min or max (default: ``n``, the number of rows).
    """
    aggs = aggs or {"n": ("count", "1")}
    size, slide = int(size_seconds) * 1_000_000, int(slide_seconds) * 1_000_000
    pane = gcd(size, slide)
    start = F.floor(F.col("__us") / F.lit(pane)) * F.lit(pane)
    partial = (df.withColumn("__us", _micros(df, ts)).where("__us is not null")
               .groupBy(*keys, start.alias("__pane"))
               .agg(*[getattr(F, kind)(F.expr(column)).alias(out) for out, (kind, column) in aggs.items()]))
    # the windows of a pane: starts are multiples of the slide, from the first
    # whose end lies behind the pane to the last that begins by it
    last = F.floor(F.col("__pane") / F.lit(slide)) * F.lit(slide)
    first = (F.floor((F.col("__pane") - F.lit(size)) / F.lit(slide)) + 1) * F.lit(slide)
    copied = partial.where(first <= last).withColumn("__start", F.explode(F.sequence(first, last, F.lit(slide))))
    merged = copied.groupBy(*keys, "__start").agg(*[_PANE_MERGE[kind](out).alias(out) for out, (kind, _) in aggs.items()])
    return merged.select(*keys, _from_micros(df, ts, F.col("__start")).alias("window_start"),
                         _from_micros(df, ts, F.col("__start") + F.lit(size)).alias("window_end"), *aggs)


def session_buckets(df: DataFrame, ts: str, gap_seconds: int,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Phase 1: (keys, bucket, first us, last us, count) per ``floor(ts / gap)``.
    A partial-aggregated ``groupBy``: a hot key spreads over its buckets."""
    gap = int(gap_seconds) * 1_000_000
    micros = _micros(df, ts)
    return (df.select(*keys, micros.alias("__us"))
              .filter(F.col("__us").isNotNull())
              .groupBy(*keys, F.floor(F.col("__us") / F.lit(gap)).alias("__b"))
              .agg(F.min("__us").alias("__lo"), F.max("__us").alias("__hi"),
                   F.count(F.lit(1)).alias("__n")))


# Buckets per block in phase 2: sessions are numbered inside blocks in
# parallel, then the blocks are stitched.
SESSION_BLOCK = 4096


def sessions_from_buckets(buckets: DataFrame, gap_seconds: int,
                          keys: Sequence[str] = (), block: int | None = None) -> DataFrame:
    """Phase 2: gap logic over bucket summaries -> (keys, start us, end us, n).

    A new session starts where a bucket's first event is more than one gap
    after the previous bucket's last event.  The buckets are cut into blocks
    of ``block`` consecutive bucket numbers:

    a. inside each (key, block), in parallel: local sessions from ``lag`` + a
       running sum;
    b. only a block's first and last session can go on in a neighbouring
       block: these edge sessions (at most two per block) are stitched by the
       same gap logic over one key's edges; all others are final.

    No task sees more than one block of buckets or the edges of one key
    (``span / (gap * block)`` rows), whatever the event volume or key skew.

    ``block=None`` picks the plan: with no keys (one global session line) the
    blocks are used, since otherwise all buckets meet in one task; with keys,
    each key's buckets (at most ``span / gap`` rows, however hot the key:
    phase 1 already absorbed its volume) are numbered by one window per key,
    which needs two fewer shuffles.
    """
    keys = list(keys)
    gap = int(gap_seconds) * 1_000_000
    if block is None:
        block = SESSION_BLOCK if not keys else 0
    if block <= 0:
        return _stitch(buckets, gap, keys, Window.partitionBy(*keys).orderBy("__b"))
    blk = F.floor(F.col("__b") / F.lit(int(block)))
    inside = [*keys, "__blk"]
    local = _numbered(buckets.withColumn("__blk", blk), gap, Window.partitionBy(*inside).orderBy("__b"))
    local = (local.groupBy(*inside, "__sid")
             .agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"), F.sum("__n").alias("__n")))
    last = F.max("__sid").over(Window.partitionBy(*inside))
    local = local.withColumn("__edge", (F.col("__sid") == 1) | (F.col("__sid") == last))
    order = Window.partitionBy(*keys).orderBy("__lo") if keys else Window.orderBy("__lo")
    edges = _stitch(local.filter("__edge").select(*keys, "__lo", "__hi", "__n"), gap, keys, order)
    middle = local.filter(~F.col("__edge")).select(
        *keys, F.col("__lo").alias("start_us"), (F.col("__hi") + F.lit(gap)).alias("end_us"),
        F.col("__n").cast("bigint").alias("n"))
    return edges.unionByName(middle)


def _numbered(spans: DataFrame, gap: int, order) -> DataFrame:
    """``__sid``: the running number of the session that each (``__lo``,
    ``__hi``) span belongs to, in the window's order."""
    prev = F.lag("__hi").over(order)
    starts = F.coalesce((F.col("__lo") - prev) > F.lit(gap), F.lit(True)).cast("long")
    return spans.withColumn("__new", starts).withColumn(
        "__sid", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def _stitch(spans: DataFrame, gap: int, keys: list[str], order) -> DataFrame:
    """Sessions of spans in the window's order (one window per key)."""
    return (_numbered(spans, gap, order).groupBy(*keys, "__sid")
            .agg(F.min("__lo").alias("start_us"),
                 (F.max("__hi") + F.lit(gap)).alias("end_us"),
                 F.sum("__n").cast("bigint").alias("n"))
            .drop("__sid"))


def sessions(df: DataFrame, ts: str, gap_seconds: int, keys: Sequence[str] = (),
             block: int | None = None) -> DataFrame:
    """T4/T5: session windows (start = first event, end = last event + gap),
    with the event count, per key or over all events when ``keys`` is empty."""
    keys = list(keys)
    out = sessions_from_buckets(session_buckets(df, ts, gap_seconds, keys), gap_seconds, keys,
                                block)
    return out.select(*keys,
                      _from_micros(df, ts, F.col("start_us")).alias("session_start"),
                      _from_micros(df, ts, F.col("end_us")).alias("session_end"),
                      "n")


def native_sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str] = ()) -> DataFrame:
    """Spark's own ``session_window`` (used as the brute-force twin in tests)."""
    return (df.groupBy(*keys, F.session_window(ts, gap).alias("w"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(*keys, F.col("w.start").alias("session_start"),
                      F.col("w.end").alias("session_end"), "n"))
