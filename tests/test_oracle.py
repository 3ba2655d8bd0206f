"""Layer 2: every registered query against its DuckDB oracle on the same
parquet tables (sf0.001 by default; ``TRIBUTARY_ORACLE_DIR=/root/testdata/sf0.01``
runs them at the driver's scale)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from conftest import SMALL
from oracle_compare import compare, duck
from tributary.plans import catalog

ORACLE_DIR = os.environ.get("TRIBUTARY_ORACLE_DIR", SMALL)

QUERIES = {n: q.build for n, q in catalog.all_queries().items()}
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def oracle_con():
    return duck(ORACLE_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle_con, name):
    res = compare(spark, name, QUERIES[name], ORACLE.get(name), ORACLE_DIR, oracle_con)
    assert res["status"] in ("ok", "rows-only"), res
    assert res["spark_rows"] > 0, res


#: Bare sketch estimates have no SQL form; their errors are held in test_loads.py.
ESTIMATES = {"distinct_sketches"}


def test_every_query_has_oracle_or_reason():
    assert set(QUERIES) - set(ORACLE) == ESTIMATES
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["depart", "emp_count_depart", "emp_id", "join_date"]
    assert df.count() > 0


TIME_QUERIES = ["event_time_label", "epoch_seconds", "window_fixed_count", "window_session_global",
                "window_label", "stream_fixed_count", "stream_session_user", "dept_count_first",
                "sql_distinct_topk"]


def test_time_queries_do_not_depend_on_session_zone(spark, oracle_con):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in TIME_QUERIES:
            res = compare(spark, name, QUERIES[name], ORACLE.get(name), ORACLE_DIR, oracle_con)
            assert res["status"] == "ok", res
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
