"""The message log: offsets, partitions, admission, stop and restart."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import types as T

from tributary.session import scratch_path
from tributary.sources import messages as M

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])


def publish(spark, log, *keys):
    M.publish(spark.createDataFrame([(k, f"m{k}") for k in keys], SCHEMA), log, ["k"])


def test_offsets_partitions_and_admission(spark):
    log = scratch_path(spark, "log")
    publish(spark, log, 3, 1, 2, 5, 4)
    publish(spark, log, 9, 8, 7)
    reader = M.MessageReader(T.StructType([*SCHEMA.fields, T.StructField("offset", T.LongType())]),
                             {"path": log, "maxrowspertrigger": "3", "rowspertask": "2"})
    ends = [reader.latestOffset()["offset"] for _ in range(5)]
    assert ends == [3, 6, 8, 8, 8] and reader.initialOffset() == {"offset": 0} and M.end_offset(log) == 8
    parts = reader.partitions({"offset": 2}, {"offset": 7})
    assert all(p.rows <= 2 for p in parts)
    got = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["k"], r["offset"]) for r in got] == [(3, 2), (4, 3), (5, 4), (7, 5), (8, 6)]
    assert reader.partitions({"offset": 8}, {"offset": 8}) == []


def test_stop_and_restart_lose_and_repeat_nothing(spark):
    log, out, ckpt = (scratch_path(spark, f"log-{x}") for x in ("m", "out", "ckpt"))
    publish(spark, log, *range(50))
    M.listen(M.stream(spark, log, SCHEMA, ckpt, 7, 3), "t", ckpt, out, until=20)
    first = M.committed_offset(ckpt)
    assert 20 <= first <= 50 and M.planned_offset(ckpt) >= first
    publish(spark, log, *range(50, 80))
    M.listen(M.stream(spark, log, SCHEMA, ckpt, 7, 3), "t", ckpt, out, until=80)
    rows = spark.read.parquet(out).collect()
    assert sorted((r.k, r.offset, r.t) for r in rows) == [(i, i, f"m{i}") for i in range(80)]
    sizes = []
    for n in sorted((n for n in os.listdir(f"{M.local_path(ckpt)}/offsets") if n.isdigit()), key=int):
        line = open(f"{M.local_path(ckpt)}/offsets/{n}").read().split("\n")[2]
        sizes.append(json.loads(line)["offset"])
    assert all(0 < b - a <= 7 for a, b in zip([0, *sizes], sizes))


def test_a_planned_batch_that_did_not_finish_is_read_again(spark):
    log, out, ckpt = (scratch_path(spark, f"log-{x}") for x in ("m", "out", "ckpt"))
    publish(spark, log, *range(30))
    M.listen(M.stream(spark, log, SCHEMA, ckpt, 10), "t", ckpt, out, until=30)
    root = M.local_path(ckpt)
    newest = max(int(n) for n in os.listdir(f"{root}/commits") if n.isdigit())
    for name in (str(newest), f".{newest}.crc"):
        os.remove(f"{root}/commits/{name}")
    M.listen(M.stream(spark, log, SCHEMA, ckpt, 10), "t", ckpt, out, until=30)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == list(range(30))


def test_a_bounded_listen_ends_and_an_unfinished_batch_is_not_seen(spark):
    log, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    publish(spark, log, 1, 2)
    os.makedirs(f"{M.local_path(log)}/00000002")  # being written
    out = M.listen(M.stream(spark, log, SCHEMA, ckpt), "t", ckpt, seconds=4)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2]


def test_other_file_systems_are_refused():
    assert M.local_path("file:///a%20b/c") == "/a b/c" and M.local_path("/x y") == "/x y"
    with pytest.raises(ValueError):
        M.local_path("hdfs://host/a")
