"""Streaming session windows without a hot state key.

Stage 1 is a streaming aggregate: gap-sized tumbling buckets per key with
(first, last, count), emitted in append mode once the watermark passes the
bucket.  State is spread over (key, bucket), so neither a global session line
nor a hot key funnels every event through one state partition.

Stage 2 stitches sessions from the bucket table with the batch logic
(``time span / gap`` rows per key).  Once the stream has ended and every bucket
is closed, these are all sessions; while it still runs, ``final_sessions``
keeps those that no event to come can join: their end (last event + gap) lies
before the closed horizon H (end of the newest closed bucket), and every event
still to come is at or after the watermark >= H.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import sessions_from_buckets


def bucket_stream(stream: DataFrame, event_time: str, gap_seconds: int,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Stage 1 (streaming, append mode): per (keys, bucket) first/last/count.
    ``event_time`` must carry a watermark."""
    gap_us = int(gap_seconds) * 1_000_000
    us = F.unix_micros(event_time)
    return (stream.groupBy(*keys, F.window(event_time, f"{int(gap_seconds)} seconds").alias("w"))
                  .agg(F.min(us).alias("__lo"), F.max(us).alias("__hi"),
                       F.count(F.lit(1)).alias("__n"))
                  .select(*keys, F.floor(F.unix_micros("w.start") / F.lit(gap_us)).alias("__b"),
                          "__lo", "__hi", "__n"))


def final_sessions(buckets: DataFrame, gap_seconds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Stage 2 (batch over the bucket table): final sessions as
    (keys, start_us, end_us, n)."""
    gap_us = int(gap_seconds) * 1_000_000
    horizon = (buckets.select(F.max("__b")).scalar() + F.lit(1)) * F.lit(gap_us)
    sess = sessions_from_buckets(buckets, gap_seconds, keys)
    return sess.filter(F.col("end_us") < horizon)
