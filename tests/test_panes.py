"""Early, on-time and late panes: numbers, restart, lateness, bounded state."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tributary.session import scratch_path
from tributary.streaming import panes as P
from tributary.streaming import streams as ST

T0 = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, k string"


class Feed:
    """A landing folder; every ``send`` is one run of the stream."""

    def __init__(self, spark, **options):
        self.spark = spark
        self.landing, self.out, self.ckpt = (scratch_path(spark, x) for x in ("pane-in", "pane-out", "pane-ckpt"))
        spark.createDataFrame([], SCHEMA).write.parquet(self.landing)
        self.options, self.progress = options, []

    def send(self, *seconds):
        rows = [(None if s is None else T0 + timedelta(seconds=s), "x") for s in seconds]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)
        stream = ST.file_stream(self.spark, self.landing, SCHEMA)
        panes = P.window_panes(stream, "ts", 10, 30, **self.options)  # a new plan each time: a restart
        P.run(panes, "panes", checkpoint=self.ckpt, output=self.out, progress=self.progress)
        return self

    def panes(self):
        base = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        rows = self.spark.read.parquet(self.out).collect()
        return sorted(((r.window_us - base) // 1_000_000, r.pane, r.timing, r.n, r.dropped) for r in rows)

    def states(self):
        return [p["stateOperators"][0]["numRowsTotal"] for p in self.progress if p["stateOperators"]][-1]


def test_early_on_time_and_late_panes_survive_restarts(spark):
    feed = Feed(spark).send(1, 2, 3).send(4, 12).send(25, 25).send(5, 26).send(41)
    assert [p for p in feed.panes() if p[0] == 0] == [
        (0, 0, "early", 3, 0), (0, 1, "early", 4, 0), (0, 2, "on_time", 4, 0), (0, 3, "late", 5, 0)]
    assert [p for p in feed.panes() if p[0] == 10] == [(10, 0, "early", 1, 0), (10, 1, "on_time", 1, 0)]
    last = {r.window_us: r.n for r in P.last_panes(spark.read.parquet(feed.out)).collect()}
    assert sorted(last.values()) == [1, 1, 3, 5]


def test_discarding_panes_add_up(spark):
    feed = Feed(spark, accumulate=False).send(1, 2, 3).send(4, 12).send(25).send(5, 5)
    own = [p for p in feed.panes() if p[0] == 0]
    assert [(p[2], p[3]) for p in own] == [("early", 3), ("early", 1), ("on_time", 0), ("late", 2)]
    assert sum(p[3] for p in own) == 6


def test_without_early_panes_a_window_comes_on_time(spark):
    feed = Feed(spark, early=False).send(1, 2).send(3).send(15).send(4)
    assert [p for p in feed.panes() if p[0] == 0] == [(0, 0, "on_time", 3, 0), (0, 1, "late", 4, 0)]


def test_rows_beyond_the_lateness_are_counted_as_dropped_and_state_is_removed(spark):
    feed = Feed(spark).send(1, 2, None).send(100).send(3, 104)
    assert [p for p in feed.panes() if p[0] == 0] == [
        (0, -1, "dropped", 0, 1), (0, 0, "early", 2, 0), (0, 1, "on_time", 2, 0)]
    assert [p[2:4] for p in feed.panes() if p[0] == 100] == [("early", 1), ("early", 2)]
    feed.send(10_000).send(10_001)
    assert feed.states() <= 2  # only the newest window is kept


def test_a_hot_window_sends_one_row_per_batch(spark):
    stream = spark.readStream.format("rate").load().select(F.col("timestamp").cast("timestamp_ntz").alias("ts"))
    plan = P.window_panes(stream, "ts", 10, 30)._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("TransformWithState"):]
    assert below.index("MapInArrow") > 0
