from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from messy import empty, hot, messy, prose

from tributary.llm import golay, simhash
from tributary.llm.components import connected_components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest_ids(rows):
    """{row number: smallest id of its component}, by comparing all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                group[top(a)] = top(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return {i: least.get(top(i)) for i in range(len(rows))}, fps, [top(i) for i in range(len(rows))]


def check(frame):
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    least, fps, _ = smallest_ids(rows)
    want = sorted(((str(d), f"{f:016x}", str(least[i])) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))))
    got = sorted((str(r.doc_id), f"{r.fingerprint & (2 ** 64 - 1):016x}", str(r.component_id))
                 for r in simhash.near_duplicates(frame).collect())
    assert got == want


def test_golay_neighbours_meet():
    rng = np.random.default_rng(3)
    v = rng.integers(0, 1 << 23, 4000)
    assert (np.bincount(golay.decode(np.arange(1 << 23))) == 2048).all()  # perfect code
    row, index = golay.nearby(v)
    keys = {}
    for r, i in zip(row.tolist(), index.tolist()):
        keys.setdefault(r, set()).add(i)
    assert {len(k) for k in keys.values()} == {1, 6}
    for bits in (0, 1, 2):
        u = v.copy()
        for r in range(len(u)):
            for b in rng.choice(23, bits, replace=False):
                u[r] ^= 1 << b
        for r, i in zip(*(x.tolist() for x in golay.nearby(u))):
            keys.setdefault(("u", bits, r), set()).add(i)
        assert all(keys[r] & keys[("u", bits, r)] for r in range(len(v)))


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_fingerprints_within_four_bits_share_a_key(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(-2**63, 2**63 - 1, 3000)
    b = a.copy()
    for r in range(len(b)):
        for k in rng.choice(64, bits, replace=False):
            b[r] ^= np.uint64(1 << int(k)).astype(np.int64)
    assert set(np.bitwise_count((a ^ b).view(np.uint64))) == {bits}
    ra, ka = simhash.all_keys(a)
    rb, kb = simhash.all_keys(b)
    both = set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))
    assert {r for r, _ in both} == set(range(len(a)))


def test_messy_documents(spark):
    check(messy(spark))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_hot_groups_and_small_blocks(spark):
    frame = hot(spark)
    check(frame)
    prints = simhash.with_fingerprints(frame, ["doc_id"])
    whole = {(r.fp, r.component) for r in simhash.components(prints).collect()}
    split = {(r.fp, r.component) for r in simhash.components(prints, block=8).collect()}
    assert whole == split


def test_deduplicate_keeps_one_of_each_group(spark):
    docs = messy(spark)
    kept = simhash.deduplicate(docs)
    assert kept.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    least, _, group = smallest_ids(rows)
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    want = sorted((least[i] is None, least[i] or 0) for i in {group.index(g) for g in group})
    assert got == want
    assert simhash.deduplicate(empty(spark)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (None, 3)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(1, 61)} | {(i, 1000) for i in range(1001, 1200)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_similar_prose_is_left_alone(spark):
    frame = spark.createDataFrame([(i, prose(i, 100)) for i in range(50)], "doc_id long, text string")
    assert simhash.deduplicate(frame).count() == 50
