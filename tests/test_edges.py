"""Layer 3: edge inputs (FIXTURES.md §4) -- empty input, NULL keys and values,
ties, invalid dates, quoted numbers, missing nested arrays, malformed JSON."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tributary.functions import text as T
from tributary.operators import aggregates as A
from tributary.operators import clean as K
from tributary.operators import cogroup as C
from tributary.operators import filters as FL
from tributary.operators import sets as S
from tributary.operators import transforms as X
from tributary.operators import windows as WN


def test_first_by_tie_takes_lowest_id_and_null_date_last(spark):
    df = spark.createDataFrame(
        [("IT", "7", "2020-01-05", 7), ("IT", "3", "2020-01-05", 3), ("IT", "1", None, 1),
         ("HR", "9", "bad-date", 9)],
        "depart string, emp_id string, join_date string, emp_key int")
    df = df.withColumn("jd", T.parse_date("join_date"))
    out = {r.depart: r for r in C.named_aggregates(
        df, "depart", n=F.count(F.lit(1)),
        first=A.first_by(["jd", "emp_key"], ["emp_id"])).collect()}
    assert out["IT"].n == 3 and out["IT"].first.emp_id == "3"
    assert out["HR"].first.emp_id == "9" and out["HR"].first["__o0"] is None


def test_null_keys_form_their_own_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(A.combine_per_key_sum(df, "k", "v")) == [("a", 3), (None, 3)]
    assert rows(A.group_by_key(df, "k", "v")) == [("a", 3, 1), (None, 1, 1), (None, 2, 1)]
    left = spark.createDataFrame([(None, "x")], "k string, v string")
    right = spark.createDataFrame([(None, "y")], "k string, v string")
    assert rows(C.cogroup(left, right, "k", "v", "v")) == [(None, "left", "x", 1), (None, "right", "y", 1)]


def test_null_values_skip_sums_and_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("b", None)], "k string, v int")
    assert rows(A.count_non_null(df, "k", "v")) == [("a", 1), ("b", 0)]
    assert rows(A.mean_per_key(df, "k", "v")) == [("a", 2.0), ("b", None)]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, v int, ts timestamp_ntz, text string")
    assert A.count_per_key(empty, "k").count() == 0
    assert A.group_by_key(empty, "k", "v").count() == 0
    assert WN.sessions(empty, "ts", 60).count() == 0
    assert WN.fixed_windows(empty, "ts", "5 minutes").count() == 0
    assert X.tokens(empty, "text", None).count() == 0
    assert S.symmetric_difference(empty.select("v"), empty.select("v")).count() == 0


def test_quoted_thousands_on_both_sides(spark):
    df = spark.createDataFrame([("S", "Buy", "1,234"), ("S", "Sell", "1,000"), ("S", "Buy", "x")],
                               "Symbol string, side string, q string")
    qty = T.remove_literal("q", ",").try_cast("bigint")
    out = df.select("Symbol", X.signed_value("side", qty).alias("q")).groupBy("Symbol").agg(F.sum("q"))
    assert out.first()[1] == 234


def test_missing_or_null_performance_is_dropped_by_flatten(spark):
    df = spark.createDataFrame([("p1", [1, 2]), ("p2", None), ("p3", [])],
                               "player string, performance array<int>")
    flat = df.select("player", F.explode("performance").alias("m"))
    assert rows(flat) == [("p1", 1), ("p1", 2)]


def test_malformed_json_goes_to_rejects(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": 1'), (3, "not json"), (4, None),
                                (5, '{"other": 2}')], "id int, props string")
    valid, rejects = K.json_valid_rejects(df, "props", "k BIGINT")
    assert rows(valid.select("id", F.col("parsed.k"))) == [(1, 1), (5, None)]
    assert sorted(r.id for r in rejects.collect()) == [2, 3, 4]


def test_anti_join_not_emptied_by_null_side(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    side = spark.createDataFrame([(None,), (3,)], "id int")
    assert FL.anti_join(df, side, "id").count() == 2


def test_date_filter_is_half_open(spark):
    d = dt.datetime(2024, 1, 15)
    df = spark.createDataFrame([(d,), (d + dt.timedelta(hours=23, minutes=59),),
                                (d + dt.timedelta(days=1),), (d - dt.timedelta(microseconds=1),)],
                               "ts timestamp_ntz")
    assert df.filter(FL.on_date("ts", "2024-01-15")).count() == 2


def test_replace_first_literal_with_dollar(spark):
    from tributary.functions import regex as RX
    df = spark.createDataFrame([("a b c",)], "s string")
    assert df.select(RX.replace_first("s", r"\s", "$1")).first()[0] == "a$1b c"


def test_group_avg_fill_with_null_group(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 10), (3, "b", None), (4, None, 5),
                                (5, None, None)], "id int, g string, v int")
    out = {r.id: r.v for r in K.fill_null_with_group_avg(df, "v", "g").collect()}
    assert out == {1: 10, 2: 10, 3: None, 4: 5, 5: 5}


def test_group_rows_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert rows(A.group_rows(df, "k", "v")) == [("a", 3, 1), (None, 1, 2), (None, 2, 2)]


def test_numeric_columns_integer_overflow_becomes_double(spark):
    df = spark.createDataFrame([("99999999999999999999",), ("1",)], "a string")
    assert dict(K.numeric_columns(df).dtypes) == {"a": "double"}


def test_hot_key_third_of_rows_group_by_key(spark):
    """One key holding about a third of lineitem: the content equals the
    brute-force counts, in one shape."""
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    keyed = li.select(F.when(F.col("l_returnflag") == "N", F.lit(-1))
                      .otherwise(F.col("l_orderkey")).alias("k"),
                      F.col("l_suppkey").alias("v"))
    assert keyed.filter("k = -1").count() > li.count() // 4
    content = A.group_by_key(keyed, "k", "v")
    want = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    got = content.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("s"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_building_a_query_runs_no_job(spark):
    """Groups, co-groups and fills plan without counting or writing first."""
    df = spark.createDataFrame([(i % 3, i) for i in range(60)], "k int, v int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "no job expected")
    try:
        A.group_by_key(df, "k", "v")
        A.all_in_group(df, "k", F.col("v") > 0)
        C.cogroup(df, df, "k", "v", "v")
        K.fill_null_with_group_avg(df, "v", "k")
        assert list(tracker.getJobIdsForGroup("build-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cogroup_keeps_a_shared_value_type(spark):
    left = spark.createDataFrame([("k", 10), ("k", 9), ("k", 9)], "key string, v int")
    right = spark.createDataFrame([("k", 100)], "key string, v int")
    out = C.cogroup(left, right, "key", "v", "v")
    assert dict(out.dtypes)["value"] == "int"
    assert rows(out) == [("k", "left", 9, 2), ("k", "left", 10, 1), ("k", "right", 100, 1)]


def test_groups_keep_null_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 2), ("a", 1)], "k string, v int")
    assert rows(A.group_by_key(df, "k", "v")) == [("a", 1, 1), ("a", 2, 1), ("a", None, 2)]
    right = spark.createDataFrame([("a", None)], "k string, v int")
    assert ("a", "right", None, 1) in rows(C.cogroup(df, right, "k", "v", "v"))


def test_sets_keep_python_semantics_with_nulls_and_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "v int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "v int")
    assert rows(S.intersect(a, b)) == [(2,), (None,)]
    assert rows(S.difference(a, b)) == [(1,)] and rows(S.difference(b, a)) == [(3,)]
    assert rows(S.symmetric_difference(a, b)) == [(1,), (3,)]


def test_combine_hook_keeps_large_keys_and_null_keys_apart(spark):
    from tributary.operators import hooks as H
    big = 9007199254740992
    df = spark.createDataFrame([(big + 1, 1.0), (big, 2.0), (None, 5.0), (None, 7.0), (3, None)], "k long, v double")
    got = rows(H.combine_hook(df, "k", "v", "sum", "sum"))
    assert [(k, v) for k, v in got if k != 3] == [(big, 2.0), (big + 1, 1.0), (None, 12.0)]
    hot = spark.range(50_000).select(F.lit(big + 1).alias("k"), F.col("id").alias("v")).repartition(5)
    assert rows(H.combine_hook(hot, "k", "v", "max", "max", acc_type="bigint")) == [(big + 1, 49_999)]


def test_text_forms_keep_null_fields(spark):
    df = spark.createDataFrame([("a", None, "c"), ("x\ny\t", "it's", None)], "p string, q string, r string")
    assert [r[0] for r in df.select(T.to_string_iterable("p", "q", "r")).collect()] == ["a,None,c", "x\ny\t,it's,None"]
    assert [r[0] for r in df.select(T.to_string_kv("q", "p")).collect()] == ["None,a", "it's,x\ny\t"]
    assert [r[0] for r in df.select(T.to_string_tuple("p", "q")).collect()] == [str(("a", None)), str(("x\ny\t", "it's"))]
    assert df.select(T.logical_clock_label(F.lit(3), "q")).first()[0] == "3-None"


def test_replace_first_leaves_the_users_pattern_alone(spark):
    from tributary.functions import regex as RX
    for text, pattern in (("xa\nb a-b", "a.b"), ("xy aa", r"([a-z])\1"), ("none", "q"), ("aXbX", "X"), ("X", "X"),
                          ("abc", "^"), ("😀 a1", r"\d"), ("ab", "(?i)B"), ("aaa", "a+"), ("one two", r"\s")):
        df = spark.createDataFrame([(text,)], "s string")
        assert df.select(RX.replace_first("s", pattern, "Z")).first()[0] == re.sub(pattern, "Z", text, count=1), (text, pattern)


def test_only_json_objects_are_valid(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, "5"), (3, "[1]"), (4, '"x"'), (5, " {} "), (6, None), (7, "{"), (8, "null")],
                               "id int, t string")
    valid, rejects = K.json_valid_rejects(df, "t", "k BIGINT")
    assert sorted(r.id for r in valid.collect()) == [1, 5]
    assert sorted(r.id for r in rejects.collect()) == [2, 3, 4, 6, 7, 8]


def test_a_column_without_values_stays_text(spark):
    df = spark.createDataFrame([(None, "1"), (None, "2")], "a string, b string")
    assert dict(K.numeric_columns(df).dtypes) == {"a": "string", "b": "bigint"}


def test_ratio_formats_are_checked_when_built(spark):
    with pytest.raises(ValueError):
        T.format_ratio("v", 2.0, "%d")
    df = spark.createDataFrame([(3,)], "v int")
    assert df.select(T.format_ratio("v", 2.0, "%.1fh")).first()[0] == "1.5h"


def test_partition_keeps_out_of_range_rows(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (None,)], "b int")
    parts = X.partition(df, F.col("b"), 2)
    assert [parts[i].count() for i in (0, 1, -1)] == [1, 1, 2]
