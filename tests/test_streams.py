"""Layer 4: streaming behaviour -- late rows, restarts from a checkpoint,
files arriving between runs, and batch = stream on the same events."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tributary.operators import windows as WN
from tributary.session import scratch_path
from tributary.streaming import streams as ST


def _at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def _drop_file(spark, folder, minutes):
    spark.createDataFrame([(_at(m),) for m in minutes], "ts timestamp_ntz") \
        .write.mode("append").parquet(folder)


def test_late_row_dropped_after_watermark(spark):
    """Batches (1, 2), (40), (3 late, 33, 80) minutes; 10 min lateness; 5 min
    windows: the 3-minute row arrives after the watermark passed its window."""
    landing = scratch_path(spark, "late_landing")
    out, ckpt = scratch_path(spark, "late_out"), scratch_path(spark, "late_ckpt")
    for batch in ([1, 2], [40], [3, 33, 80]):
        _drop_file(spark, landing, batch)
        s = ST.with_event_time(ST.file_stream(spark, landing, "ts timestamp_ntz"), "ts", "10 minutes")
        counts = WN.fixed_windows(s, "event_time", "5 minutes")
        ST.run_to_files(counts, "late", output=out, checkpoint=ckpt)
    got = {r.window_start.strftime("%H:%M"): r.n
           for r in spark.read.parquet(out).collect()}
    assert got == {"00:00": 2, "00:30": 1, "00:40": 1}


def test_file_arriving_between_runs_processed_once(spark):
    landing = scratch_path(spark, "ingest_landing")
    out, ckpt = scratch_path(spark, "ingest_out"), scratch_path(spark, "ingest_ckpt")
    _drop_file(spark, landing, [1, 2, 3])
    s = ST.file_stream(spark, landing, "ts timestamp_ntz")
    ST.run_to_files(s, "ingest", output=out, checkpoint=ckpt)
    _drop_file(spark, landing, [4])
    s = ST.file_stream(spark, landing, "ts timestamp_ntz")
    ST.run_to_files(s, "ingest", output=out, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 4


def test_stream_to_its_end_equals_batch(spark):
    """Every window of the batch result, the last ones included."""
    from tributary.functions import text as T
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    s = ST.file_stream(spark, f"{SMALL}/events.parquet*", ev.schema)
    out = spark.read.parquet(ST.run_to_end(s, "ts", "twin", lambda e: WN.fixed_windows(
        ST.with_event_time(e, "ts", "1 minute"), "event_time", "5 minutes")))
    stream = out.select(T.ltz_to_ntz("window_start").alias("window_start"),
                        T.ltz_to_ntz("window_end").alias("window_end"), "n").filter(ST.before_closing("window_start"))
    batch = WN.fixed_windows(ev, "ts", "5 minutes")
    assert stream.count() == batch.count() and stream.exceptAll(batch).count() == 0
    assert stream.agg(F.sum("n")).first()[0] == ev.count()


def test_update_mode_has_no_file_form(spark):
    s = ST.file_stream(spark, f"{SMALL}/events.parquet*", spark.read.parquet(f"{SMALL}/events.parquet").schema)
    with pytest.raises(ValueError):
        ST.run_to_files(s.groupBy("user_id").count(), "upd", output_mode="update")


def test_complete_mode_holds_all_keys_over_batches(spark):
    landing, out, ckpt = (scratch_path(spark, f"cm_{x}") for x in ("in", "out", "ckpt"))
    for keys in (["a", "b"], ["b", "c"]):
        spark.createDataFrame([(k,) for k in keys], "k string").write.mode("append").parquet(landing)
        counts = ST.file_stream(spark, landing, "k string").groupBy("k").count()
        ST.run_to_files(counts, "cm", output_mode="complete", output=out, checkpoint=ckpt)
    assert {r.k: r["count"] for r in spark.read.parquet(out).collect()} == {"a": 1, "b": 2, "c": 1}


def test_ingested_files_leave_the_landing_folder(spark):
    landing, out, ckpt = (scratch_path(spark, f"rm_{x}") for x in ("in", "out", "ckpt"))
    for n in (3, 2):
        _drop_file(spark, landing, list(range(n)))
        ST.ingest_and_remove(spark, landing, "ts timestamp_ntz", "rm", output=out, checkpoint=ckpt)
        assert ST.files_in(spark, landing).isEmpty()
    assert spark.read.parquet(out).count() == 5


def test_valid_rejects_split_in_stream(spark):
    topic = scratch_path(spark, "vr_topic")
    spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": '), (3, None), (4, '{"k": 4}')],
                          "id bigint, value string").write.parquet(topic)
    valid, rejects = scratch_path(spark, "vr_valid"), scratch_path(spark, "vr_rej")
    s = ST.file_stream(spark, topic, "id bigint, value string")
    ST.run_foreach_batch(s, "vr", ST.valid_rejects_sink(
        valid, rejects, "value", "k BIGINT",
        lambda d: d.select("id", "batch_id", F.col("parsed.k").alias("k"))))
    assert sorted(r.k for r in spark.read.parquet(valid).collect()) == [1, 4]
    assert sorted(r.id for r in spark.read.parquet(rejects).collect()) == [2, 3]


def test_stream_tap_reports_metrics(spark):
    from tributary.sinks import writers as W
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    s = ST.file_stream(spark, f"{SMALL}/events.parquet*", ev.schema)
    tapped = W.tap(s, "tap_test", rows=F.count(F.lit(1)))
    progress = []
    ST.run_to_files(tapped.select("event_id"), "tap", progress=progress)
    seen = sum(p["observedMetrics"]["tap_test"]["rows"]
               for p in progress if p.get("observedMetrics", {}).get("tap_test"))
    assert seen == ev.count()
