from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from conftest import SMALL
from messy import empty, messy
from oracle_compare import compare, duck
from test_decontaminate import brute as brute_hits
from test_mixing import targets
from test_quality import brute as brute_counts
from test_simhash import smallest_ids
from test_token_orc import expected, tokenizer  # noqa: F401

import __spark_entry__ as E
from tributary.llm.queries import ORACLE, QUERIES
from tributary.plans.registry import table
from tributary.session import materialize

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_the_listed_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "benchmark_decontamination", "source_mixing", "token_output"]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def test_every_stage_against_brute_force(spark, tokenizer):  # noqa: F811
    docs = table(spark, SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SMALL), f"test-{name}"))
        if name != "token_output":
            assert out[-1].columns == DOC_COLUMNS
    rows = [[tuple(r) for r in frame.collect()] for frame in out]
    all_docs, quality, unique, clean, mixed, tokens = rows

    # Quality: nothing that fails the base rule, all clean labelled documents.
    text = {d: t for d, t, *_ in all_docs}
    counts = {d: brute_counts(t) for d, t in text.items()}
    fails = {d for d, c in counts.items() if c[0] < 10 or 100 * c[4] > 20 * c[0]}
    kept = {r[0] for r in quality}
    good = {r.doc_id: r.quality for r in table(spark, SMALL, "labels").collect()}
    assert not kept & fails
    assert {d for d, q in good.items() if q == 1 and d not in fails} <= kept
    assert not {d for d, q in good.items() if q == 0} & kept

    pairs = [(r[0], r[1]) for r in quality]
    least, _, _ = smallest_ids(pairs)
    assert sorted(r[0] for r in unique) == sorted(set(least.values()))

    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    hits = brute_hits([(r[0], r[1]) for r in unique], items)
    assert sorted(r[0] for r in clean) == sorted(d for (d, _), h in hits.items() if h[1] == 0)

    size = {r[0]: counts[r[0]][0] for r in clean}
    by_source, taken = defaultdict(int), defaultdict(int)
    for r in clean:
        by_source[r[3]] += size[r[0]]
    for r in mixed:
        taken[r[3]] += size[r[0]]
    want = targets(by_source)
    assert max(Counter(r[0] for r in mixed).values()) <= 2 and {r[:2] for r in mixed} <= {r[:2] for r in clean}
    assert all(abs(taken[s] - want[s]) <= max(size.values()) for s in want)

    assert sorted(tokens, key=lambda r: r[1]) == expected(tokenizer, sorted((r[0], r[1]) for r in mixed))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_the_small_tables(spark, name):
    res = compare(spark, name, QUERIES[name], ORACLE.get(name), SMALL, duck(SMALL))
    assert res["status"] in ("ok", "rows-only") and res["spark_rows"] > 0, res


def test_messy_documents_run_through_all_stages(spark):
    for docs in (messy(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SMALL), f"messy-{name}")
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
