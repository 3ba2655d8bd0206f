"""Sessions (two-phase vs Spark's native session_window, edge cases) and
window boundaries."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from tributary.operators import windows as WN


def _diff(a, b):
    cols = a.columns
    return a.select(cols).exceptAll(b.select(cols)).count() + b.select(cols).exceptAll(a.select(cols)).count()


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
@pytest.mark.parametrize("keys", [[], ["user_id"], ["event_type"]])
def test_two_phase_equals_native(spark, sf_dir, keys):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ours = WN.sessions(ev, "ts", 30 * 60, keys)
    native = WN.native_sessions(ev, "ts", "30 minutes", keys)
    assert ours.count() == native.count()
    assert _diff(ours, native) == 0


def _at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def test_session_exact_gap_edges(spark):
    mins = [0, 30, 60, 91, 95, 125, 156]
    df = spark.createDataFrame([(_at(m),) for m in mins], "ts timestamp_ntz")
    ours = WN.sessions(df, "ts", 30 * 60)
    native = WN.native_sessions(df, "ts", "30 minutes")
    assert ours.count() == 3
    assert _diff(ours, native) == 0


def test_session_one_second_over_gap_splits(spark):
    df = spark.createDataFrame([(_at(0),), (_at(30) + dt.timedelta(seconds=1),)], "ts timestamp_ntz")
    assert WN.sessions(df, "ts", 30 * 60).count() == 2


def test_sessions_ignore_null_time(spark):
    df = spark.createDataFrame([(_at(0),), (None,), (_at(5),)], "ts timestamp_ntz")
    out = WN.sessions(df, "ts", 30 * 60).collect()
    assert len(out) == 1 and out[0].n == 2


def test_hot_key_sessions(spark):
    """One key holding most rows: phase 2 sees only its buckets."""
    hot = [(1, _at(i)) for i in range(0, 3000, 7)]
    cold = [(k, _at(k * 3)) for k in range(2, 60)]
    df = spark.createDataFrame(hot + cold, "k int, ts timestamp_ntz")
    ours = WN.sessions(df, "ts", 30 * 60, ["k"])
    native = WN.native_sessions(df, "ts", "30 minutes", ["k"])
    assert _diff(ours, native) == 0
    buckets = WN.session_buckets(df, "ts", 30 * 60, ["k"]).filter("k = 1").count()
    assert buckets <= 3000 // 30 + 1


def test_window_boundary_event(spark):
    """An event exactly on a boundary belongs to the window that starts there."""
    df = spark.createDataFrame([(_at(5),), (_at(4) + dt.timedelta(seconds=59),)], "ts timestamp_ntz")
    out = {r.window_start: r.n for r in WN.fixed_windows(df, "ts", "5 minutes").collect()}
    assert out == {_at(0): 1, _at(5): 1}


def test_sliding_assigns_each_event_twice(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    total = WN.sliding_windows(ev, "ts", "300 seconds", "150 seconds").agg(F.sum("n")).first()[0]
    assert total == 2 * ev.count()


@pytest.mark.parametrize("block", [1, 2, 3, 7])
@pytest.mark.parametrize("keys", [[], ["user_id"]])
def test_block_stitching_equals_native(spark, block, keys):
    """Tiny blocks force sessions across many block boundaries."""
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    ours = WN.sessions(ev, "ts", 30 * 60, keys, block=block)
    native = WN.native_sessions(ev, "ts", "30 minutes", keys)
    assert ours.count() == native.count()
    assert _diff(ours, native) == 0


@pytest.mark.parametrize("block", [1, 2, 5])
def test_block_stitching_edges(spark, block):
    mins = [0, 30, 60, 91, 95, 125, 156, 300, 330, 331, 362, 400]
    df = spark.createDataFrame([(_at(m),) for m in mins], "ts timestamp_ntz")
    ours = WN.sessions(df, "ts", 30 * 60, block=block)
    native = WN.native_sessions(df, "ts", "30 minutes")
    assert _diff(ours, native) == 0
