from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import empty, messy, messy_rows, prose

from tributary.llm import repeats
from tributary.llm.suffix_arrays import spread


def brute(texts: list[str | None], depth: int) -> list[tuple]:
    """Every window of every text, counted in a dictionary."""
    data = [(t or "").encode() for t in texts]
    many = Counter(t[i:i + depth] for t in data for i in range(len(t) - depth + 1))
    out = []
    for t in data:
        hit = np.zeros(len(t) + 1, np.int8)
        for i in range(len(t) - depth + 1):
            if many[t[i:i + depth]] > 1:
                hit[i:i + depth] = 1
        hit[len(t)] = 0
        kept = bytes(b for b, h in zip(t, hit, strict=False) if not h)
        out.append((len(t), int(hit.sum()), int((np.diff(hit, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


def found(spark, texts: list[str | None], depth: int, parts: int = 3) -> list[tuple]:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    rows = repeats.remove_repeats(docs, depth=depth, keep=["doc_id"]).select("row.doc_id", "res.*").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in sorted(rows)]


def corpus(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    passage, line = prose(1, 60), "the same line stands here again\n"
    texts: list[str | None] = [prose(i, rng.randint(1, 120)) for i in range(20)]
    texts += [texts[0], texts[3], texts[3] + " tail", "head " + texts[4], None, "", "é" * 150, "é" * 151]
    texts += [f"{prose(50 + i, 20)} {passage[rng.randint(0, 150):]} {prose(80 + i, 20)}" for i in range(12)]
    texts += [line * 30, "a" * 900, "ab" * 300, line * 12 + "x", prose(7, 200)[:300] + "Q" + prose(7, 200)[301:]]
    return texts


@pytest.mark.parametrize("depth", [200, 37, 5])
def test_against_every_window(spark, depth):
    assert found(spark, corpus(depth), depth) == brute(corpus(depth), depth)


def test_hot_gram_is_counted_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 2)
    assert found(spark, corpus(3), 60) == brute(corpus(3), 60)


def test_counted_windows_come_as_spans(spark):
    """Near copies: a row per span of a stretch that occurs once, not per window."""
    base, depth = prose(5, 60).encode()[:120], 40
    edited = [base[:i] + b"#%02d#" % i + base[i + 4:] for i in range(0, 100, 5)]
    rows = [(1, s, 1, s, s, 7, t) for s, t in enumerate(edited)] + [(1, 99, 3, 99, 99, 0, base)]
    ddl = "gram long, stretch long, n long, k1 long, k2 long, at long, bytes binary"
    got = repeats.count_windows(spark.createDataFrame([*rows, rows[0]], ddl), depth).collect()
    many = Counter()
    for _, _, n, *_, t in rows:
        many.update({t[i:i + depth]: n for i in range(len(t) - depth + 1)})
    want = []
    for _, _, n, k1, k2, at, t in rows:
        hit = np.array([many[t[i:i + depth]] > 1 for i in range(len(t) - depth + 1)])
        want += [(k1, k2, at + a, at + b) for a, b in zip(*repeats.covered(hit, depth), strict=True) if n == 1]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) < 3 * len(edited)


def test_small_batches_of_the_sort(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SORTED_AT_ONCE", 50)
    assert found(spark, corpus(4), 200) == brute(corpus(4), 200)


def test_a_third_of_all_rows_share_a_passage(spark):
    passage = prose(2, 50)
    texts = [f"{prose(100 + i, 10)} {passage} {prose(900 + i, 10)}" if i % 3 == 0 else passage if i % 3 == 1
             else prose(2000 + i, 30) for i in range(300)]
    assert found(spark, texts, 200, parts=7) == brute(texts, 200)


def test_messy_rows_and_clashing_columns(spark):
    rows = repeats.remove_repeats(messy(spark)).select("row.*", "res.n_bytes", "res.n_removed", "res.kept_sha256").collect()
    texts = [r[1] for r in messy_rows()]
    expected = Counter((r[0], b[0], b[1], b[3]) for r, b in zip(messy_rows(), brute(texts, 200), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in rows) == expected
    assert repeats.remove_repeats(empty(spark)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=6), st.integers(1, 12))
def test_runs_hold_every_window_once(texts, depth):
    """Every window is in one run, with the gram that its bytes choose."""
    grams = repeats.Grams(min(repeats.GRAM, depth))
    owner, gram, at, size, several = repeats.runs(texts, grams, depth)
    windows, of = [], {}
    for o, g, a, n, _ in zip(*[x.tolist() for x in (owner, gram, at, size, several)], strict=True):
        for i in range(a, a + n - depth + 1):
            windows.append((o, i))
            assert of.setdefault(texts[o][i:i + depth], g) == g
    assert sorted(windows) == [(o, i) for o, t in enumerate(texts) for i in range(len(t) - depth + 1)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=90).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=5), st.integers(1, 60))
def test_radix_sort_finds_equal_windows(texts, depth):
    sizes = np.array([len(t) for t in texts])
    windows = np.maximum(sizes - depth + 1, 0)
    at = spread(np.cumsum(sizes) - sizes, windows)
    if not len(at):
        return
    group = np.repeat(np.arange(len(texts)) % 2, windows)
    whole = b"".join(texts)
    got = repeats.together(group, np.frombuffer(whole, np.uint8), at, depth)
    many = Counter((g, whole[a:a + depth]) for g, a in zip(group.tolist(), at.tolist(), strict=True))
    assert got.tolist() == [many[g, whole[a:a + depth]] > 1 for g, a in zip(group.tolist(), at.tolist(), strict=True)]
