"""Plan checks for the scale rules: no Python on the data path of built-in
operators, no single-partition exchange above unaggregated rows, the expected
number of shuffles, and filters/projections reaching the parquet scan."""

from __future__ import annotations

import re

import pytest

from conftest import SMALL
from tributary.plans import catalog

QUERIES = {n: q.build for n, q in catalog.all_queries().items()}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")
# One JSON array in byte ranges: its state has no column expression.
PYTHON_READERS = ("src_json_array_ranges",)
# Streams run to completion when built; their plans are checked by their tests.
PLANNED = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan_of(spark, name):
    df = QUERIES[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(spark, n) for n in PLANNED}


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_in_builtin_operators(plans, name):
    if name.startswith("udf_") or name in PYTHON_READERS:
        return
    assert not any(node in plans[name] for node in PYTHON_NODES), name


@pytest.mark.parametrize("name", PLANNED)
def test_single_partition_only_above_aggregates(plans, name):
    """Every SinglePartition exchange feeds on aggregated rows (a global
    aggregate's partials, bucket summaries), never on raw input rows."""
    lines = plans[name].splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            assert "Aggregate" in "".join(lines[i + 1:i + 12]), (name, child)


def exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange (hashpartitioning|SinglePartition|rangepartitioning)", plan))


@pytest.mark.parametrize("name,expected", [
    ("dept_count_first", 1),          # count + arg-min in one aggregate
    ("cogroup", 1),                   # tagged union, one grouping
    ("group_by_key", 1),
    ("array_forall", 1),
    ("set_intersect", 1),             # tagged union, one grouping
    ("set_difference", 1),
    ("set_symmetric_difference", 1),  # tagged union, one grouping
    ("combine_per_key_sum", 1),
    ("emission_shape_agg", 2),        # sum + exact distinct count
    ("map_length", 0),
    ("word_tokens", 0),
])
def test_exchange_counts(plans, name, expected):
    assert exchanges(plans[name]) == expected, plans[name]


def test_filter_pushed_to_scan(plans):
    p = plans["sql_distinct_topk"]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "TakeOrderedAndProject" in p


def test_projection_pruned_at_scan(plans):
    m = re.search(r"ReadSchema: struct<([^>]*)>", plans["map_length"])
    assert m and m.group(1) == "p_partkey:bigint,p_name:string"


def test_whole_table_average_is_a_scalar_subquery(plans):
    p = plans["fill_null_with_avg"]
    assert "Subquery" in p and "Window" not in p and "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_no_cross_joins_anywhere(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_words_are_counted_before_they_meet_the_vocabulary(plans):
    p = plans["side_input_semi"]
    join = min(p.index(j) for j in ("BroadcastHashJoin", "SortMergeJoin") if j in p)
    assert "HashAggregate" in p[join:], p  # below the join


def test_global_sessions_scan_the_events_once(spark):
    df = QUERIES["window_session_global"](spark, SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet|Scan parquet", final)) - final.count("ReusedExchange") <= 1, final


def test_library_never_pulls_data_to_the_driver():
    """Static rule: no ``toPandas``/``localCheckpoint`` anywhere in the library,
    and ``collect``/``first`` only on bounded frames: after a ``limit``, or on
    a global aggregate (one row)."""
    import os as _os
    root = _os.path.join(_os.path.dirname(_os.path.dirname(_os.path.abspath(__file__))), "tributary")
    pulls = 0
    for dirpath, _, files in _os.walk(root):
        for f in files:
            if not f.endswith(".py") or f == "plan_report.py":
                continue
            rel = _os.path.relpath(_os.path.join(dirpath, f), root)
            if rel.startswith("llm"):
                continue  # checked by its own tests
            src = open(_os.path.join(dirpath, f), encoding="utf-8").read()
            assert "toPandas(" not in src and "localCheckpoint" not in src, rel
            for line in src.splitlines():
                if ".collect()" in line or ".first()" in line:
                    pulls += 1
                    bounded = ("limit(" in line or (".agg(" in line and "groupBy" not in line)
                               or 'select("path")' in line  # file names of a load
                               or "mapInArrow(summarize" in line)  # a few numbers per byte range
                    assert bounded, (rel, line.strip())
    assert pulls >= 3
