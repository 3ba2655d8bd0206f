"""Prefix scans, ordered combiners and the skewed full outer join against
plain Python, with hot ties, hot groups and NULLs."""

from __future__ import annotations

import random
from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tributary.operators import hooks as H
from tributary.operators import ordered as O
from tributary.operators.skew_join import full_outer_skewed, grid, hot_keys
from tributary.plans import q_ordered
from tributary.plans.registry import table


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables stay in many ranges, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_rows(n=900, seed=1):
    """Two thirds of the rows tie on one order key, a third have a NULL group."""
    rng = random.Random(seed)
    return [(i, None if i % 3 == 0 else rng.choice("ab"), 7 if rng.random() < .66 else rng.choice([None, *range(20)]),
             None if rng.random() < .1 else rng.randint(-50, 50)) for i in range(n)]


SCHEMA = "id long, g string, o int, v long"


def by_order(r):
    return (r[2] is not None, r[2] or 0, r[0])


def test_row_numbers_over_hot_ties(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(6, "id")
    got = {r.id: r.n for r in O.row_numbers(df, ["o", "id"], out="n").collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(data, key=by_order), 1)}
    ties = O.row_numbers(df.select("o"), ["o"], out="n").collect()
    assert sorted(r.n for r in ties) == list(range(1, len(data) + 1))
    assert [r.o for r in sorted(ties, key=lambda r: r.n)] == [r[2] for r in sorted(data, key=by_order)]


def test_hot_ties_spread_over_ranges(spark):
    df = spark.range(5000).select(F.lit(1).alias("o"), "id")
    placed = O.in_order(df.repartition(4), ["o"]).groupBy(F.shiftright("__at", 33)).count().collect()
    assert max(r["count"] for r in placed) < 5000 / 2


def test_row_numbers_per_group(spark):
    data = hot_rows(seed=2)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r.id: r.n for r in O.row_numbers(df, [F.desc("id")], by=["g"], out="n").collect()}
    expected = {}
    for g in (None, "a", "b"):
        expected |= {r[0]: i for i, r in enumerate(sorted((r for r in data if r[1] == g), key=lambda r: -r[0]), 1)}
    assert got == expected


def test_running_measures(spark):
    data = hot_rows(seed=3)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = O.running(df, ["id"], {"s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"),
                                 "a": ("avg", "v")}, by=["g"]).collect()
    for g in (None, "a", "b"):
        seen = []
        for r in sorted((r for r in got if r.g == g), key=lambda r: r.id):
            seen += [] if r.v is None else [r.v]
            assert (r.s, r.c, r.lo, r.hi) == ((sum(seen), len(seen), min(seen), max(seen)) if seen else (None, 0, None, None))
            assert r.a is None if not seen else abs(r.a - sum(seen) / len(seen)) < 1e-9


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert O.row_numbers(none, ["o"]).count() == 0
    assert O.running(none, ["o"], {"s": ("sum", "v")}).count() == 0
    assert H.ordered_combine_hook(none, "v", ["o"], q_ordered.Concatenate(), "array<long>").count() == 0
    assert full_outer_skewed(none.select("g", "o"), none.select("g", "v"), "g").count() == 0


def test_no_window_over_all_rows(spark):
    orders = table(spark, SMALL, "orders").select("o_orderkey", "o_orderdate")
    plan = O.row_numbers(orders, ["o_orderdate"])._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "HashAggregate" in window[:window.index("Scan parquet")]


@pytest.mark.parametrize("fan", [2, 16])
def test_ordered_concatenation(spark, monkeypatch, fan):
    """``a + b`` is not ``b + a``: any slip of the order shows."""
    monkeypatch.setattr(H, "MERGE_FAN", fan)
    data = hot_rows(seed=4)
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    (whole,) = H.ordered_combine_hook(df, "v", ["o", "id"], q_ordered.Concatenate(), "array<long>").collect()
    assert whole.combined == [r[3] for r in sorted(data, key=by_order)]
    parts = H.ordered_combine_hook(df, "v", ["o", "id"], q_ordered.Concatenate(), "array<long>", by=["g"]).collect()
    assert {r.g: r.combined for r in parts} == {
        g: [r[3] for r in sorted(data, key=by_order) if r[1] == g] for g in (None, "a", "b")}


def test_drawdown_merges_like_it_adds():
    rng, d = random.Random(5), q_ordered.Drawdown()
    for _ in range(300):
        values = [rng.randint(-9, 9) for _ in range(rng.randint(0, 12))]
        sums = list(accumulate(values, initial=0))
        cut = rng.randint(0, len(values))
        a, b = d.create(), d.create()
        for v in values[:cut]:
            a = d.add(a, v)
        for v in values[cut:]:
            b = d.add(b, v)
        fall = max(sums[i] - sums[j] for i in range(len(sums)) for j in range(i, len(sums)))
        assert d.extract(d.merge(a, b)) == fall


def outer(left, right):
    out = Counter()
    for k, x in left:
        met = [y for j, y in right if j == k and k is not None]
        out.update([(k, x, y) for y in met] or [(k, x, None)])
    out.update((k, None, y) for k, y in right if k is None or all(j != k for j, _ in left))
    return out


@pytest.mark.parametrize("cells", [1, 6, 200])
def test_full_outer_with_hot_keys(spark, cells):
    """A third of both sides share a key, another hot key stands on one side
    only, another third has none."""
    rng = random.Random(6)
    left = [("hot" if i % 3 == 0 else None if i % 3 == 1 else rng.choice(["l", "l", "x", "y", f"k{i}"]), i) for i in range(240)]
    right = [("hot" if i % 3 == 0 else None if i % 9 == 1 else rng.choice(["r", "r", "x", f"k{i}", f"k{i + 1}"]), i) for i in range(120)]
    l_df = spark.createDataFrame(left, "k string, a long").repartition(3)
    r_df = spark.createDataFrame(right, "k string, b long").repartition(2)
    got = Counter(tuple(r) for r in full_outer_skewed(l_df, r_df, "k", share=0.05, cells=cells).collect())
    assert got == outer(left, right)
    hot = {h.k: (h.l, h.r) for h in hot_keys(l_df, r_df, "k", 0.05)}
    assert hot["hot"] == (80, 40) and hot["l"][1] == 0 and None not in hot


def test_no_cell_holds_the_hot_key(spark, monkeypatch):
    """A third of both sides is one key: no cell of the grid gets more than a
    tenth of its rows from either side."""
    from tributary.operators import skew_join
    kept = {}
    write = skew_join.materialize

    def spy(df, name, **kw):
        kept[name] = write(df, name, **kw)
        return kept[name]

    monkeypatch.setattr(skew_join, "materialize", spy)
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") + 3000).alias("k"), F.col("id").alias("b"))
    joined = full_outer_skewed(left, right, "k", cells=256)
    assert joined.where("k = 0").count() == 2000 * 2000
    for name in ("outer-left", "outer-right"):
        cells = kept[name].groupBy("__r", "__c").count().collect()
        assert len(cells) >= 200 and max(r["count"] for r in cells) <= 2000 / 10


def test_grid_copies_the_small_side_only():
    assert grid(1_000_000, 1, 64) == (64, 1)
    assert grid(1, 1_000_000, 64) == (1, 64)
    rows_, columns = grid(1000, 1000, 64)
    assert rows_ == columns == 8


def test_light_keys_take_the_plain_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "n")], "k long, a string")
    right = spark.createDataFrame([(2, "b"), (None, "m")], "k long, b string")
    assert rows(full_outer_skewed(left, right, "k")) == rows(
        left.join(right, "k", "full_outer").select("k", "a", "b"))
