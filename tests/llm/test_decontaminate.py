from __future__ import annotations

import random
import re

import numpy as np
import pytest
from messy import empty, messy, prose
from pyspark.sql import functions as F

from tributary.llm import decontaminate, suffix_arrays

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=10):
    """{(id, text): (n_words, n_hit, sorted items, longest match)}."""
    grams = {}
    for name, text in items:
        w = words(text)
        for i in range(len(w) - min(window, len(w)) + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + window]), set()).add("" if name is None else str(name))
    out = {}
    for i, text in docs:
        w = words(text)
        hit, met, longest = set(), set(), 0
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in grams:
                    hit |= set(range(k, k + n))
                    met |= grams[g]
                    for _, t in items:
                        v = words(t)
                        for p in range(len(v)):
                            m = 0
                            while m < min(len(v) - p, len(w) - k) and v[p + m] == w[k + m]:
                                m += 1
                            longest = max(longest, m)
        out[(i, text)] = (len(w), len(hit), sorted(met), longest)
    return out


def test_suffix_array_order_and_search():
    rng = random.Random(4)
    for size in (1, 2, 30, 200):
        ids = np.array([rng.randrange(4) for _ in range(size)])
        order = suffix_arrays.build(ids, size)
        assert order.tolist() == sorted(range(size), key=lambda i: ids[i:].tolist())
        query = np.array([1, 2, 3, 1, 1, 2, 5])
        at, lengths = np.array([0, 0, 1, 3, 5]), np.array([1, 2, 3, 4, 2])
        lo = suffix_arrays.lower_bound(ids, order, query, at, lengths)
        hi = suffix_arrays.lower_bound(ids, order, query, at, lengths, after_equal=True)
        size_found, where = suffix_arrays.longest(ids, order, query, at, lengths)
        for a, n, x, y, s, p in zip(at, lengths, lo, hi, size_found, where, strict=True):
            q = query[a:a + n].tolist()
            assert sorted(order[x:y].tolist()) == [i for i in range(size) if ids[i:i + n].tolist() == q]
            best = max(next((k for k in range(n, 0, -1) if ids[i:i + k].tolist() == q[:k]), 0) for i in range(size))
            assert s == best and ids[order[p]:order[p] + s].tolist() == q[:s]


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_scan_matches_brute_force(spark, block_bytes):
    passage = prose(50, 40)
    items = [(1, passage), (2, prose(51, 25)), (10, "Short item HERE"), (None, prose(52, 12)), (5, None), (6, ""),
             (2, prose(53, 15)), (7, "a a a a a a a a a a a a")]
    docs = [(1, prose(60, 50) + " " + passage.upper() + " " + prose(61, 20)), (2, prose(51, 25)), (3, None), (4, ""),
            (5, "x short, item--here! y"), (6, prose(52, 12) + " " + prose(53, 15)), (7, "a " * 40),
            (8, " ".join(passage.split()[:9])), (9, " ".join(passage.split()[5:16])), (None, passage), (1, passage)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.scan(frame, bench, block_bytes=block_bytes).select("row.*", "res.*").collect()
    want = brute(docs, items)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, r["items"], r.longest) == want[(r.doc_id, r.text)], r
        if r.longest:
            own = words(r.text)[r.longest_word:r.longest_word + r.longest]
            assert any(("" if i is None else str(i)) == r.longest_item
                       and words(t)[r.longest_item_word:r.longest_item_word + r.longest] == own for i, t in items)


def test_messy_documents_pass_or_go(spark):
    docs = messy(spark)
    bench = spark.createDataFrame([(1, prose(3, 80)), (2, None)], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("doc_id <> 3 or doc_id is null").collect()))
    assert decontaminate.decontaminate(docs, bench.where("item_id = 2")).count() == docs.count()
    assert decontaminate.decontaminate(empty(spark), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_copies_of_a_passage_in_many_documents(spark):
    passage = prose(50, 40)
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(passage)).otherwise(
        F.concat(F.lit("clean text number "), F.col("id"))).alias("text"))
    bench = spark.createDataFrame([(i, passage) for i in range(20)], "item_id long, text string")
    found = decontaminate.scan(docs, bench, keep=["doc_id"]).where("res.n_hit > 0")
    assert found.count() == 300
    assert {tuple(r[0]) for r in found.select("res.items").distinct().collect()} == {tuple(sorted(map(str, range(20))))}


def test_twenty_blocks_are_read_one_at_a_time(spark, monkeypatch):
    """The blocks go to the shared folder; the driver gets no item, and a task
    holds one block while it searches."""
    items = [(i, prose(100 + i, 30)) for i in range(80)]
    docs = [(i, prose(300 + i, 20) + " " + " ".join(items[i][1].split()[j] for j in range(5, 25)) + " " + prose(100 + (i * 7) % 80, 30))
            for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t) for _, t in items)
    stored = decontaminate.write_blocks(bench, "item_id", "text", 10, size // 20)
    assert stored.count() >= 18 and len(stored.inputFiles()) >= stored.count()
    (one,) = decontaminate.read_block(stored.inputFiles()[0])
    assert 0 < len(one.names) < 20
    got = decontaminate.scan(frame, bench, block_bytes=size // 20).select("row.*", "res.*").collect()
    want = brute(docs, items)
    assert [(r.n_words, r.n_hit, r["items"], r.longest) for r in got] == [want[(r.doc_id, r.text)] for r in got]
    whole = decontaminate.scan(frame, bench).select("row.*", "res.*").collect()
    assert sorted(map(str, got)) == sorted(map(str, whole))
