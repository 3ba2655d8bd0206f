"""Ranged JSON arrays, evolving appends, incremental summaries, stored sketches,
windows by panes."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import MEDIUM, SMALL, rows
from tributary.operators import sketches as SK
from tributary.operators import windows as WN
from tributary.plans.registry import table
from tributary.session import scratch_path
from tributary.sinks import evolving as EV
from tributary.sinks import summary as SM
from tributary.sinks import writers as W
from tributary.sources import files as SRC
from tributary.sources import json_arrays as JA


# ------------------------------------------------------------ S10

DOC = "id long, text string, tags array<string>, nest struct<a: array<struct<b: string>>>"


def documents(n, seed):
    rng = random.Random(seed)
    bits = ["}", "{", "[", "]", '"', "\\", ",", "\\\\", "é", "😀", "\n", '\\"}', "]}", " ", "x", ": "]
    text = lambda: "".join(rng.choices(bits, k=rng.randint(0, 12)))
    return [{"id": i, "text": text(), "tags": [text() for _ in range(rng.randint(0, 3))],
             "nest": {"a": [{"b": text()} for _ in range(rng.randint(0, 2))]}} for i in range(n)]


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(size)) for k in before]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size,indent", [(64, None), (997, 1), (1 << 20, None)])
def test_one_array_in_byte_ranges(spark, tmp_path, small_ranges, size, indent):
    """Braces, quotes and backslashes in texts, cut at every place."""
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(" " + json.dumps(documents(60, i), indent=indent, ensure_ascii=i == 1) + "\n", "utf-8")
    small_ranges(size)
    found = JA.read_json_array_ranges(spark, str(tmp_path), DOC)
    if size < 1000:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = sorted((r.asDict(recursive=True) for r in found.collect()), key=str)
    assert got == sorted((d for i in range(3) for d in documents(60, i)), key=str)
    assert rows(found.select("id", "text")) == rows(SRC.read_json_array(spark, str(tmp_path), DOC).select("id", "text"))


def test_odd_arrays(spark, tmp_path, small_ranges):
    small_ranges(16)
    cases = {"[]": [], "": [], "[{}]": [None], ' [ {"id": 1} , 2, "}{", null, {"id": 3} ] ': [1, 3],
             '[{"id": 1}, {"id": 2': [1], '[{"id": 7, "text": "' + "x}" * 90 + '"}]': [7]}
    for i, (text, ids) in enumerate(cases.items()):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "a.json").write_text(text)
        assert sorted((r.id for r in JA.read_json_array_ranges(spark, str(tmp_path / f"d{i}"), DOC).collect()), key=str) == ids


def test_one_file_is_written_from_many_tasks_and_cut_once(spark, tmp_path, small_ranges):
    docs = spark.range(0, 300, 1, 5).select("id", F.expr("concat('{\"}', id)").alias("text"))
    path = str(tmp_path / "one")
    W.write_json_arrays(docs, path, one_file=True)
    (part,) = (tmp_path / "one").glob("part-*")
    assert sorted((d["id"], d["text"]) for d in json.loads(part.read_text())) == rows(docs)
    small_ranges(997)
    found = JA.read_json_array_ranges(spark, path, "id long, text string")
    assert rows(found) == rows(docs)
    assert found.inputFiles() and not [f for f in found.inputFiles() if path in f]  # the ranges are not parsed again


def test_states_compose_like_one_pass():
    text = json.dumps(documents(40, 9))
    pieces = [p + "}" for p in text.split("}")]
    rng = random.Random(1)
    for _ in range(50):
        cuts = sorted(rng.sample(range(1, len(pieces)), 5))
        parts = ["".join(pieces[a:b]) for a, b in zip([0, *cuts], [*cuts, len(pieces)], strict=True)]
        begins = JA.compose([(i, *JA.effect(p)) for i, p in enumerate(parts)])
        for i in range(len(parts)):
            odd, depth, _ = JA.effect("".join(parts[:i]))
            assert begins[i] == (odd, depth)


# ------------------------------------------------------------ K2


def docs(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values], "doc string")


def test_loads_with_other_fields_and_types(spark):
    path = scratch_path(spark, "evolve")
    EV.append_documents(docs(spark, {"a": 1, "b": {"x": 1}, "l": [1]}, {"a": 2}, "[1]", "broken", None, "7"), "doc", path)
    EV.append_documents(docs(spark, {"a": 1.5, "b": {"y": "t"}, "l": [2.5], "c": True}), "doc", path)
    EV.append_documents(docs(spark), "doc", path)
    EV.append_documents(docs(spark, {"a": 3, "b": {"x": 1}, "l": [1]}), "doc", path)
    found = EV.read_evolving(spark, path)
    assert {f.name: f.dataType.simpleString() for f in found.schema} == {
        "a": "double", "b": "struct<x:bigint,y:string>", "l": "array<double>", "c": "boolean"}
    assert sorted((r.a, r.b and (r.b.x, r.b.y), r.l, r.c) for r in found.collect()) == [
        (1.0, (1, None), [1.0], None), (1.5, (None, "t"), [2.5], True), (2.0, None, None, None), (3.0, (1, None), [1.0], None)]
    EV.append_documents(docs(spark, {"a": "text", "b": 7}), "doc", path)
    texts = {r.a: r.b for r in EV.read_evolving(spark, path).collect()}
    assert texts == {"1": '{"x":1}', "2": None, "1.5": '{"y":"t"}', "3": '{"x":1}', "text": "7"}
    with pytest.raises(ValueError):
        EV.append_documents(docs(spark, {"A": 1}), "doc", path)


def test_widening_rules():
    s, i, d, b = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
    assert EV.widened(i, d) == d and EV.widened(T.IntegerType(), i) == i and EV.widened(b, i) == s
    assert EV.widened(T.DateType(), T.TimestampType()) == T.TimestampType() and EV.widened(T.ArrayType(i), i) == s
    assert EV.widened(T.NullType(), i) == i and EV.widened(T.ArrayType(i), T.ArrayType(d)) == T.ArrayType(d)


def test_conflicts_inside_one_load_become_text(spark):
    found = EV.parse_autodetected(docs(spark, {"v": 1, "t": "2020-01-01"}, {"v": {"w": 2}, "odd name`": 1}), "doc")
    assert found.schema["v"].dataType == T.StringType()
    assert sorted(r.v for r in found.collect()) == ["1", '{"w":2}'] and "odd name`" in found.columns


# ------------------------------------------------------------ K4


def test_second_update_reads_new_files_only_and_failures_keep_the_old_version(spark, monkeypatch):
    landing, root = scratch_path(spark, "sum-in"), scratch_path(spark, "sum")
    summary = SM.Summary(spark, root, ["k"], {"s": ("sum", "v"), "n": ("count", "v"), "hi": ("max", "v"),
                                              "lo": ("min", "v"), "m": ("avg", "v")})

    def load(*values):
        spark.createDataFrame(values, "k string, v long").coalesce(1).write.mode("append").parquet(landing)

    def state():
        return rows(summary.read())

    load(("a", 1), ("a", 3), (None, 5), ("b", None))
    assert summary.update(landing) == 1 and summary.version() == 1
    assert state() == rows(spark.createDataFrame([("a", 4, 2, 3, 1, 2.0), ("b", None, 0, None, None, None), (None, 5, 1, 5, 5, 5.0)],
                                                 "k string, s long, n long, hi long, lo long, m double"))
    assert summary.update(landing) == 0 and summary.version() == 1
    load(("a", 10), ("c", 7))
    assert summary.new_files(landing).count() == 1
    read = spark.read.parquet

    def failing(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(type(spark.read), "parquet", lambda self, *p: failing() if len(p) == 1 and p[0].endswith("/ledger") else read(*p))
        with pytest.raises(OSError):
            summary.update(landing)
    assert summary.version() == 1 and ("a", 4, 2, 3, 1, 2.0) in state()
    assert summary.update(landing) == 1 and summary.version() == 2
    assert ("a", 14, 3, 10, 1, 14 / 3) in state() and ("c", 7, 1, 7, 7, 7.0) in state()
    assert ("a", 4, 2, 3, 1, 2.0) in rows(summary.read(1))


def test_a_replaced_file_is_refused(spark, tmp_path):
    import os
    frame = spark.createDataFrame([("a", 1)], "k string, v long")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    summary = SM.Summary(spark, str(tmp_path / "sum"), ["k"], {"n": ("count", "v")})
    summary.update(str(tmp_path / "in"))
    (file,) = (tmp_path / "in").glob("*.parquet")
    os.utime(file, (1, 1))
    with pytest.raises(ValueError):
        summary.update(str(tmp_path / "in"))


# ------------------------------------------------------------ A10


def test_merged_sketches_stay_within_their_error(spark):
    orders = table(spark, MEDIUM, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    path = scratch_path(spark, "sk")
    SK.store_sketches(orders.where("o_orderkey % 2 = 0"), ["month"], "o_custkey", path)
    stored = SK.store_sketches(orders.where("o_orderkey % 2 = 1"), ["month"], "o_custkey", path)
    got = {r.y: (r.n_rows, r.estimate) for r in SK.merge_sketches(stored.withColumn("y", F.year("month")), ["y"]).collect()}
    exact = {r.y: (r.n, r.d) for r in orders.groupBy(F.year("month").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("d")).collect()}
    assert got.keys() == exact.keys()
    for year, (n, d) in exact.items():
        assert got[year][0] == n and abs(got[year][1] - d) <= 4 * 0.0163 * d + 1
    (whole,) = SK.merge_sketches(stored, []).collect()
    total = orders.select("o_custkey").distinct().count()
    assert abs(whole.estimate - total) <= 4 * 0.0163 * total + 1


def test_approximate_counts_of_the_summary(spark):
    from tributary.plans import q_aggregates
    named = q_aggregates._emission_rows(spark, MEDIUM)
    near = {(r.Year, r.Country): r.gas_count for r in q_aggregates.emission_estimates(named).collect()}
    exact = {(r.Year, r.Country): r.gas_count for r in q_aggregates.emission_shape_agg(spark, MEDIUM).collect()}
    assert near.keys() == exact.keys() and all(abs(near[k] - exact[k]) <= max(1, .1 * exact[k]) for k in exact)


def test_approximate_counts_are_held_against_the_exact_ones(spark, tmp_path, monkeypatch):
    from tributary.plans import q_aggregates
    spark.range(36_000).select(
        F.expr("case when id % 3 < 2 then date '1994-01-01' + cast(id % 3 * 366 as int) end").alias("l_shipdate"),
        F.expr("case when id % 2 = 0 then 'A' end").alias("l_returnflag"),
        (F.col("id") % 18_000).alias("l_suppkey"), F.lit(1.5).alias("l_extendedprice"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = [(y, c, 9000.0, True) for y in ("1994", "1995", None) for c in ("A", None)]
    columns = ("Year", "Country", "total_emission", "gas_count_close")
    found = q_aggregates.emission_shape_agg_approx(spark, str(tmp_path))
    assert tuple(found.columns) == columns and rows(found) == sorted(want, key=str) and len(want) == 6
    monkeypatch.setattr(q_aggregates, "EMISSION_RSD", 0.39)  # sketches too small for the bound
    assert not all(r.gas_count_close for r in q_aggregates.emission_shape_agg_approx(spark, str(tmp_path)).collect())


# ------------------------------------------------------------ T3


@pytest.mark.parametrize("size,slide", [(3600, 10), (300, 150), (250, 100), (60, 60), (60, 90)])
def test_panes_make_the_same_windows(spark, size, slide):
    events = table(spark, SMALL, "events").limit(300)
    got = rows(WN.sliding_by_panes(events, "ts", size, slide))
    if slide <= size:
        assert got == rows(WN.sliding_windows(events, "ts", f"{size} seconds", f"{slide} seconds"))
    else:  # windows with gaps between them
        us = [r.us for r in events.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).collect()]
        assert sum(r[2] for r in got) == sum(u // 10**6 % slide < size for u in us)


def test_rows_are_copied_per_pane_not_per_event(spark):
    """An hour every 10 s: the explode stands above the aggregate of the rows."""
    plan = WN.sliding_by_panes(table(spark, SMALL, "events"), "ts", 3600, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Relation") and "Aggregate" in plan[plan.index("Generate"):plan.index("Relation")]
    assert "Expand" not in plan
