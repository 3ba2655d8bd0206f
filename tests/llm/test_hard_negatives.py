from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, w int, block string, rows string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(parts)


def brute(rows: list[tuple]) -> list[tuple]:
    used = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * float(np.float32(x))) for x in v]
        used.append((i, (label + 1) % 10 if i % 7 == 0 else label, ints))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for n, (i, label, v) in enumerate(used):
        if i % 50:
            continue
        others = [(-score(v, w), j, other) for m, (j, other, w) in enumerate(used) if m != n]
        for minus, p, _ in sorted(x for x in others if x[2] == label)[:5]:
            fits = [(s, j) for s, j, other in sorted(others) if other != label and -50 * minus <= -100 * s <= -95 * minus]
            out += [(i, p, rank, j, -minus, -s) for rank, (s, j) in enumerate(fits[:3], 1)]
    return sorted(out)


def found(df) -> list[tuple]:
    rows = hn.mine(df, F.col("vec_id") % 50 == 0, label=hn.shifted_label())
    return sorted(map(tuple, rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                         "negative_score").collect()))


def clusters(seed: int, n: int, width: int = 8, labels: int = 4) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (labels * 3, width))
    return [(i, [float(x) for x in (centres[i % len(centres)] + rng.normal(0, .3, width)).astype(np.float32)],
             i % len(centres) % labels) for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "CHUNK_ROWS", 3)
    monkeypatch.setattr(hn, "PAGE_BLOCKS", 4)


def test_against_all_pairs(spark, small_blocks):
    rows = clusters(1, 700)
    expected = brute(rows)
    assert found(frame(spark, rows)) == expected and len(expected) > 50


def test_messy_rows(spark, small_blocks):
    """Nulls, non-finite numbers, copies, ties, short and empty vectors, hot label."""
    rng = random.Random(3)
    rows = [(i, [rng.choice((0., .5, 1.)) for _ in range(4)], 0 if i % 3 else rng.randint(0, 9)) for i in range(160)]
    rows += [(50, [.5, .5, 1., 0.], 0)] * 3 + [(7, [1.] * 4, 2)] * 2
    rows += [(None, [1.] * 4, 1), (300, None, 1), (350, [1., None, 1., 1.], 1), (400, [1., math.nan, 1., 1.], 1),
             (450, [math.inf] * 4, 1), (500, [1.] * 4, None), (550, [], 1), (600, [1., 1.], 1), (650, [-1.] * 4, 0)]
    assert found(frame(spark, rows)) == brute(rows)


def test_large_numbers_are_exact(spark, small_blocks):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.uniform(1e5, 3e6))) for _ in range(3)], i % 2) for i in range(0, 220)]
    assert found(frame(spark, rows)) == brute(rows)
    assert hn.inner(np.array([[1e30]]), np.array([[1e30], [-1e30], [2.0]])).tolist() == [[2**63 - 1, -2**63, 2**63 - 1]]


def test_few_rows_and_empty_table(spark):
    rows = clusters(2, 3)
    assert found(frame(spark, rows)) == brute(rows)
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(0, [1.], 1)])) == []


def test_zone_maps_leave_blocks_unread(spark, small_blocks):
    """On clustered vectors most blocks are not read for a window."""
    rows = clusters(4, 1200, width=6)
    df = frame(spark, rows)
    found_ = hn.Candidates(df.where("vec_id is not null"))
    anchors = found_.rows.where("vec_id % 50 = 0").withColumn("chunk", F.col("row"))
    chunks = hn._packed(anchors, "chunk", found_.width).select("chunk", "rows", "ids", "labels", "vectors")
    whole = chunks.withColumn("windows", F.expr("array(struct(0 as of, cast(null as bigint) as positive))"))
    best = hn._units(whole, found_, None, True, found_.width).groupBy("chunk", "w").agg(F.max_by("block", "bound").alias("block"))
    units = best.groupBy("chunk", "block").agg(F.collect_list("w").alias("ws")).withColumn(
        "least", F.lit(None).cast("array<long>"))
    start = hn._read(units, whole, found_, True, 5, found_.width)
    floors = start.groupBy("chunk", "w").agg(F.min("score").alias("floor"))
    floors = best.join(floors, ["chunk", "w"]).groupBy("chunk").agg(F.collect_list(F.struct("w", "block", "floor")).alias("floors"))
    read = best.count() + hn._units(whole, found_, floors, True, found_.width).count()
    assert read < 0.35 * anchors.count() * found_.blocks.count()


def test_zone_bounds_hold_every_score():
    rng = np.random.default_rng(0)
    block, anchors = rng.integers(-300, 300, (40, 5)).astype(float), rng.integers(-300, 300, (9, 5)).astype(float)
    least, most = hn.bounds(anchors, block.min(0)[None], block.max(0)[None])
    scores = hn.inner(anchors, block)
    assert (least[:, 0] <= scores.min(1)).all() and (most[:, 0] >= scores.max(1)).all()


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = hn.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(side ** dims))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_a_read_that_names_its_blocks_skips_the_others(spark, small_blocks):
    found_ = hn.Candidates(frame(spark, clusters(6, 400)))
    assert found_.blocks.count() == 25
    plan = found_.blocks.where(F.col("block").isin([1, 2]))._jdf.queryExecution().executedPlan()
    assert len(plan.executeCollect()) == 2
    assert plan.collectLeaves().head().metrics().apply("numOutputRows").value() == 2
