"""Layer 1: the reference's inline datasets with their expected results
(FIXTURES.md §3)."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import fixture_data as D
from conftest import rows
from tributary.functions import regex as RX
from tributary.functions import text as T
from tributary.operators import aggregates as A
from tributary.operators import clean as K
from tributary.operators import cogroup as C
from tributary.operators import filters as FL
from tributary.operators import sets as S
from tributary.operators import transforms as X


def one_col(spark, values, name="value", typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def test_p1_length(spark):
    df = one_col(spark, [D.FARM_LINE])
    assert X.map_length(df, "value").first()["length"] == 47


def test_p3_word_lengths(spark):
    df = one_col(spark, [D.FARM_LINE])
    got = [(r.word, r.length) for r in X.word_lengths(df, "value", ",").orderBy("pos").collect()]
    assert got == [("Onion", 5), (" Strawberry", 11), ("Carrot", 6), ("Potato", 6),
                   ("Eggplant", 8), ("Tomato", 6)]


def test_f1_evens(spark):
    df = one_col(spark, D.INTS, typ="int")
    assert sorted(r.value for r in df.filter(FL.is_even("value")).collect()) == [2, 6, 8, 22, 32, 44]


def test_p19_bands(spark):
    df = one_col(spark, D.INTS, typ="int")
    parts = X.partition(df, X.age_band("value"), 4)
    got = {i: sorted(r.value for r in p.collect()) for i, p in parts.items()}
    assert got == {0: [1, 2, 3, 5, 6, 8], 1: [22, 32, 33], 2: [44, 45], 3: [65, 99], -1: []}


def test_p19_band_edges(spark):
    edges = [19, 20, 21, 22, 40, 41, 42, 55, 56]
    df = one_col(spark, edges, typ="int").withColumn("b", X.age_band("value"))
    got = dict((r.value, r.b) for r in df.collect())
    assert [got[e] for e in edges] == [0, 3, 3, 1, 1, 3, 2, 2, 3]


def test_p19_parity(spark):
    df = one_col(spark, D.FRUIT_NAMES)
    parts = X.partition(df, X.parity_branch(F.length("value")), 2)
    assert sorted(r.value for r in parts[0].collect()) == ["banana", "kiwi", "orange", "strawberry"]
    assert sorted(r.value for r in parts[1].collect()) == ["avacado", "graps"]


def test_u1_flatten(spark):
    a = spark.createDataFrame(D.COUNTRIES_1, "name string, population bigint")
    b = spark.createDataFrame(D.COUNTRIES_2, "name string, population bigint")
    assert S.union_all(a, b).count() == 10


def test_a1_group_by_key(spark):
    df = spark.createDataFrame([*D.KV_SMALL, ("aa", 1)], "k string, v int")
    got = rows(A.group_by_key(df, "k", "v"))
    assert got == sorted((k, v, 2 if (k, v) == ("aa", 1) else 1) for k, v in set(D.KV_SMALL))


def test_j1_cogroup(spark):
    jobs = spark.createDataFrame(D.JOBS + [("Zed", "Pilot")], "name string, job string")
    hob = spark.createDataFrame(D.HOBBIES, "name string, hobby string")
    got = {(r.name, r.side): (r.value, r.n) for r in C.cogroup(jobs, hob, "name", "job", "hobby").collect()}
    assert len({name for name, _ in got}) == 6
    assert got["Alice", "left"] == ("Software Engineer", 1) and got["Alice", "right"] == ("Reading", 1)
    assert got["Zed", "left"] == ("Pilot", 1) and ("Zed", "right") not in got


def test_p10_to_string(spark):
    sp = spark.createDataFrame(D.SPECIES[:1], "a string, b string")
    assert sp.select(T.to_string_kv("a", "b")).first()[0] == "Simba,Lion"
    cs = spark.createDataFrame(D.CITY_STATE[:1], "a string, b string")
    assert cs.select(T.to_string_tuple("a", "b")).first()[0] == "('NY', 'New York')"
    q = spark.createDataFrame([("it's", 'a"b')], "a string, b string")
    assert q.select(T.to_string_tuple("a", "b")).first()[0] == "(\"it's\", 'a\"b')"
    lt = spark.createDataFrame(D.LETTERS[:1], "k string, v int")
    assert lt.select(T.to_string_kv("k", "v")).first()[0] == "abc,1"


def test_p9_kv_swap(spark):
    lt = spark.createDataFrame(D.LETTERS, "k string, v int")
    assert rows(X.kv_swap(lt)) == sorted([(1, "abc"), (4, "pqr"), (2, "xyz"), (8, "abc"), (7, "xyz")])


def test_a16_distinct(spark):
    df = spark.createDataFrame([(D.FRUITS_TUPLE,)], "value array<string>")
    assert A.distinct_rows(df).count() == 1
    got = df.select(F.array_distinct("value")).first()[0]
    assert got == ["mango", "pineapple", "guava", "himalayan berry", "apple"]


def test_a3_concat(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(D.INT_LISTS)], "ord int, arr array<int>")
    flat = A.concat_lists_rows(df, ["ord"], "arr").orderBy("ord", "pos")
    assert [r.item for r in flat.collect()] == [1, 2, 3, 5, 6, 7, 11, 4, 3]


def test_a2_a4_a7_letters(spark):
    lt = spark.createDataFrame(D.LETTERS, "k string, v int")
    assert rows(A.combine_per_key_sum(lt, "k", "v")) == [("abc", 9), ("pqr", 4), ("xyz", 9)]
    assert A.count_globally(lt).first()["n"] == 5
    assert all(r.n == 1 for r in A.count_per_element(lt).collect())
    assert rows(A.count_per_key(lt, "k")) == [("abc", 2), ("pqr", 1), ("xyz", 2)]
    assert A.mean_globally(lt, "v").first()["mean"] == pytest.approx(4.4)
    assert rows(A.mean_per_key(lt, "k", "v")) == [("abc", 4.5), ("pqr", 4.0), ("xyz", 4.5)]


def test_a4_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert A.count_globally(empty).first()["n"] == 0
    assert A.count_globally(empty, without_defaults=True).count() == 0
    assert A.mean_globally(empty, "v").first()["mean"] is None


PATTERN = r"([a-d][a-d]|[0-9]+)"


def test_regex_catalogue(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(D.SOLD_LINES)], "i int, value string")
    by_i = lambda d, c: [r[c] for r in d.orderBy("i").collect()]
    assert by_i(RX.matches(df, "value", PATTERN), "match") == ["aa", "bb", "cc", "dd"]
    assert by_i(RX.all_matches(df, "value", PATTERN), "groups") == [
        ["aa", "aa"], ["bb", "bb"], ["cc", "cc"], ["dd", "dd"]]
    kv = RX.matches_kv(df, "value", PATTERN, key_group=0)
    assert all(r.key == r.value for r in kv.collect()) and kv.count() == 4
    assert by_i(RX.find(df, "value", PATTERN), "match") == ["aa", "bb", "cc", "dd", "35"]
    assert by_i(RX.find_all(df, "value", PATTERN), "matches") == [
        ["aa", "10"], ["bb", "9"], ["cc", "22"], ["dd", "58"], ["35", "bb"]]
    assert RX.find_kv(df, "value", PATTERN, key_group=0).count() == 10
    first = df.filter("i = 0")
    assert first.select(RX.replace_first("value", r"\s", ",")).first()[0] == "aa,sold qty is 10"
    assert first.select(RX.replace_all("value", r"\s", ",")).first()[0] == "aa,sold,qty,is,10"
    assert first.select(RX.split("value", " ")).first()[0] == ["aa", "sold", "qty", "is", "10"]


def test_p21_labels(spark):
    ev = spark.createDataFrame(D.PLANTS_EVENT_TIME, "name string, season bigint")
    got = sorted(r[0] for r in ev.select(T.event_time_label("season", "name")).collect())
    assert got == ["2020-04-01 00:00:00-Strawberry", "2020-06-01 00:00:00-Carrot"]
    lg = spark.createDataFrame(D.PLANTS_LOGICAL, "name string, event_id bigint")
    got = sorted(r[0] for r in lg.select(T.logical_clock_label("event_id", "name")).collect())
    assert got == ["1-Strawberry", "4-Carrot"]


def test_p20_side_input_band(spark):
    df = one_col(spark, [D.RIVER_TEXT])
    words = X.tokens(df, "value", None)
    band = X.length_band_filter(words, "word", 2, 10)
    want = [w for w in D.RIVER_TEXT.split() if 2 < len(w) < 10]
    assert [r.word for r in band.orderBy("pos").collect()] == want and len(want) == 59
    assert band.select("word").distinct().count() == len(set(want)) == 50


def test_f4_side_input_membership(spark):
    df = one_col(spark, [D.RIVER_TEXT])
    words = X.tokens(df, "value", " ")
    side = one_col(spark, ["AI", "harbour", "glacier"], name="word")
    got = rows(A.count_per_key(FL.semi_join(words, side, "word"), "word"))
    assert got == [("AI", 1), ("harbour", 2)]


def test_p18_composite(spark):
    from tributary.plans.q_rows import word_frequency
    df = one_col(spark, [D.RIVER_TEXT], name="text")
    freq = df.transform(word_frequency(5))
    lead = [re.match(r"[^.|,()]+", w) for w in D.RIVER_TEXT.split()]
    want = Counter(m[0] for m in lead if m and len(m[0]) > 5)
    assert dict(rows(freq)) == want
    assert want["harbour"] == 3 and want["village"] == 1 and want["(AI"] == 0


def test_f5_f7_news(spark):
    df = one_col(spark, [D.NEWS_TEXT])
    lines = X.tokens(df, "value", "\n", out="line").withColumn("line", T.strip_ws("line"))
    kept = (lines.filter(~FL.in_literals("line", D.NEWS_CHANNELS))
                 .filter(FL.regex_not_match("line", r"^[0-9]+ (hours|hour) ago$"))
                 .filter(FL.non_empty_after_strip("line"))
                 .orderBy("pos"))
    got = [r.line for r in kept.collect()]
    assert len(got) == 4
    assert got == ["Ferry line opens a third pier", "By Nora Quay",
                   "“Nobody asked the villages…”: council puts off the bridge’s repair",
                   "Snow is late, 12 hours ago is not"]


def test_w1_w3_null_fill(spark):
    df = spark.createDataFrame(D.CUSTOMERS_NULLS, "customer_id bigint, name string, age bigint, city string")
    stated = K.fill_null_with_avg(df, "age")
    assert [r.age for r in stated.orderBy("customer_id").collect()] == [25, 33, 40, 33, 35]
    written = K.fill_null_with_avg(df, "age", as_written=True)
    assert [r.age for r in written.orderBy("customer_id").collect()] == [25, 20, 40, 20, 35]
    filled = K.fill_null_constant(df, "city", "Unknown")
    assert filled.filter("customer_id = 3").first().city == "Unknown"


def test_a11_payments(spark):
    df = spark.createDataFrame(D.PAYMENTS, "trns_date string, merchant string, amount int, paymentmode string")
    out = A.conditional_sums(df, "merchant", "amount", {
        "online_amount": F.col("paymentmode") == "ONLINE",
        "cash_amount": F.col("paymentmode") == "CASH"})
    assert rows(out, "merchant", "online_amount", "cash_amount") == [
        ("M1", 500, 250), ("M2", 550, 0), ("M3", 0, 600), ("M4", 200, 0)]


def test_u2_u5_sets(spark):
    a, b = one_col(spark, D.SET_1, typ="int"), one_col(spark, D.SET_2, typ="int")
    assert rows(S.intersect(a, b)) == [(4,), (5,)]
    assert rows(S.union_distinct(a, b)) == [(i,) for i in range(1, 9)]
    assert rows(S.difference(b, a)) == [(6,), (7,), (8,)]
    assert rows(S.symmetric_difference(a, b)) == [(1,), (2,), (3,), (6,), (7,), (8,)]


def test_r12_r13(spark):
    df = one_col(spark, [D.SENTENCE])
    st = T.text_stats("value")
    r = df.select(st["n_words"], st["n_chars_no_ws"]).first()
    assert (r[0], r[1]) == (3, 21)
    book = one_col(spark, [D.BOOK_PAGES], typ="int")
    assert book.select(T.format_ratio("value", 60)).first()[0] == "5.00h"
    with pytest.raises(ValueError):
        T.format_ratio("value", 60, "%.2qh")


def test_p12_p13_names(spark):
    assert K.sanitize_name("Emissions (metric tons CO2e)") == "Emissions__metric_tons_CO2e"
    assert K.sanitize_name("Ü-x") == "Ü_x"
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        K.sanitize_column_names(df)
    df2 = spark.createDataFrame([(1, 2, 3)], "x int, _c1 int, `Unnamed: 2` int")
    assert K.drop_unnamed(df2).columns == ["x"]


def test_p14_numeric_columns(spark):
    df = spark.createDataFrame([("1,5", "7", "a", "1d"), ("2,25", "8", "3", "2")],
                               "p string, q string, r string, s string")
    out = K.numeric_columns(df)
    types = dict(out.dtypes)
    assert types == {"p": "double", "q": "bigint", "r": "string", "s": "string"}
    assert rows(out, "p", "q") == [(1.5, 7), (2.25, 8)]


def test_x3_combine_hook_hot_key(spark):
    """The lifted combiner equals the built-in aggregate, with a hot key and a
    NULL key, across many batches."""
    from tributary.operators import hooks as H
    data = [(1, float(i)) for i in range(5000)] + [(k, float(k)) for k in range(2, 300)] + [(None, 7.0)]
    df = spark.createDataFrame(data, "k int, v double").repartition(7)
    got = H.combine_hook(df, "k", "v", "sum", "sum")
    want = df.groupBy("k").agg(F.sum("v").alias("combined"))
    assert got.count() == want.count()
    assert got.exceptAll(want.select("k", "combined")).count() == 0


def test_x2_flat_map_hook(spark):
    from tributary.operators import hooks as H
    df = one_col(spark, ["a-b", "c"])
    out = H.flat_map_hook(df, lambda r: ({"piece": p} for p in r["value"].split("-")), "piece string")
    assert sorted(r.piece for r in out.collect()) == ["a", "b", "c"]


def test_whitespace_class_equals_python(spark):
    """The whitespace class equals ``str.isspace`` over every code point."""
    chars = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    df = spark.createDataFrame([(chars,)], "s string")
    got = df.select(F.regexp_extract_all("s", F.lit(f"({T.WS_CLASS})"), 1)).first()[0]
    assert got == [c for c in chars if c.isspace()]
    s = " \x1c a b\xa0 c　"
    row = spark.createDataFrame([(s,)], "s string").select(T.split_ws("s"), T.strip_ws("s")).first()
    assert row[0] == s.split() and row[1] == s.strip()


def test_groups_have_one_shape_at_any_size(spark):
    """A key with very many rows comes out in the same columns, and with the
    same rows, as a key with few."""
    small = spark.createDataFrame([("h", i % 7) for i in range(14)], "k string, v int")
    large = spark.range(300_000).select(F.lit("h").alias("k"), (F.col("id") % 7).cast("int").alias("v"))
    a, b = (A.group_by_key(df, "k", "v") for df in (small, large))
    assert a.dtypes == b.dtypes
    assert [r[:2] for r in rows(a)] == [r[:2] for r in rows(b)] == [("h", v) for v in range(7)]
    assert sum(r[2] for r in rows(b)) == 300_000
