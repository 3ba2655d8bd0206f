"""Projection, filter, key/value, formatting, set and top-k queries
(SURVEY P1-P4, P7-P10, P19-P21, F1-F12, J4-J5, U1-U5, L1-L2, R12-R24, W1-W3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import clean as K
from ..operators import filters as FL
from ..operators import sets as S
from ..operators import transforms as X
from ..session import spread
from .registry import query, table


def docs(spark, sf_dir, *cols):
    """Columns of the documents table, spread over the task slots before the
    per-word work (see ``session.spread``)."""
    return spread(table(spark, sf_dir, "documents").select(*cols))

# ---------------------------------------------------------------- P1-P4


@query("map_length", ids=("P1",), sql="""
select p_partkey, cast(length(p_name) as integer) as length from part
""")
def map_length(spark, sf_dir):
    return X.map_length(table(spark, sf_dir, "part"), "p_name", keep=["p_partkey"])


@query("flatmap_split", ids=("P2",), sql="""
select p_partkey, unnest(string_split(p_name, ' ')) as item from part
""")
def flatmap_split(spark, sf_dir):
    return X.flat_map_split(table(spark, sf_dir, "part"), "p_name", " ", keep=["p_partkey"])


@query("pardo_word_len", ids=("P3",), sql="""
select p_partkey, cast(pos as integer) as pos, word, cast(length(word) as integer) as length
from (select p_partkey, unnest(range(len(w))) as pos, unnest(w) as word
      from (select p_partkey, string_split(p_name, ' ') as w from part))
""")
def pardo_word_len(spark, sf_dir):
    return X.word_lengths(table(spark, sf_dir, "part"), "p_name", " ", keep=["p_partkey"])


@query("word_tokens", ids=("P4", "R11"), headline=True, sql="""
select doc_id, cast(pos as integer) as pos, word
from (select doc_id, unnest(range(len(w))) as pos, unnest(w) as word
      from (select doc_id, string_split(text, ' ') as w from documents where text is not null))
""")
def word_tokens(spark, sf_dir):
    return X.tokens(docs(spark, sf_dir, "doc_id", "text"), "text", " ", keep=["doc_id"])


# ---------------------------------------------------------------- P7-P10


@query("kv_keys", ids=("P7",), sql="select o_custkey as k from orders")
def kv_keys(spark, sf_dir):
    return X.keys(table(spark, sf_dir, "orders"), "o_custkey")


@query("kv_values", ids=("P8",), sql="select o_totalprice as v from orders")
def kv_values(spark, sf_dir):
    return X.values(table(spark, sf_dir, "orders"), "o_totalprice")


@query("kv_swap", ids=("P9",), sql="select o_totalprice as k, o_custkey as v from orders")
def kv_swap(spark, sf_dir):
    return X.kv_swap(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice")


def customers_with_gaps(spark, sf_dir):
    """customer with NULL segments where the balance is negative."""
    c = table(spark, sf_dir, "customer")
    return c.withColumn("c_mktsegment", K.nullify("c_mktsegment", F.col("c_acctbal") < 0))


_GAPS_SQL = """
with c as (select c_custkey, c_name, c_nationkey, case when c_acctbal >= 0 then c_mktsegment end as seg from customer)
"""


@query("to_string_kvs", ids=("P10",), sql=_GAPS_SQL + """
select c_custkey, coalesce(seg, 'None') || ',' || cast(c_nationkey as varchar) as kv from c
""")
def to_string_kvs(spark, sf_dir):
    c = customers_with_gaps(spark, sf_dir)
    return c.select("c_custkey", T.to_string_kv("c_mktsegment", "c_nationkey").alias("kv"))


@query("to_string_element", ids=("P10",), sql=_GAPS_SQL + """
select c_custkey, '(' || chr(39) || c_name || chr(39) || ', ' || coalesce(chr(39) || seg || chr(39), 'None') || ')' as element
from c
""")
def to_string_element(spark, sf_dir):
    c = customers_with_gaps(spark, sf_dir)
    return c.select("c_custkey", T.to_string_tuple("c_name", "c_mktsegment").alias("element"))


@query("to_string_iterable", ids=("P10",), sql=_GAPS_SQL + """
select concat_ws(',', c_custkey, coalesce(seg, 'None'), c_name) as line from c
""")
def to_string_iterable(spark, sf_dir):
    c = customers_with_gaps(spark, sf_dir)
    return c.select(T.to_string_iterable("c_custkey", "c_mktsegment", "c_name").alias("line"))


# ---------------------------------------------------------------- P19, P20


@query("partition_frames", ids=("P19",), sql="""
select p_partkey, case when length(p_name) % 4 < 3 then length(p_name) % 4 else -1 end as frame from part
""")
def partition_frames(spark, sf_dir):
    """``partition`` into three frames; rows of a fourth branch land in -1."""
    p = table(spark, sf_dir, "part")
    frames = X.partition(p, F.pmod(F.length("p_name"), F.lit(4)), 3)
    first, *rest = [df.select("p_partkey", F.lit(i).cast("bigint").alias("frame")) for i, df in frames.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


@query("partition_mod", ids=("P19", "X5"), sql="""
select p_partkey, cast(length(p_name) % 2 as integer) as branch from part
""")
def partition_mod(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return X.with_branch(p.select("p_partkey", "p_name"),
                         X.parity_branch(F.length("p_name"))).drop("p_name")


@query("partition_bands", ids=("P19", "X5"), sql="""
select p_partkey, p_size,
  case when p_size < 20 then 0 when p_size > 21 and p_size < 41 then 1
       when p_size > 41 and p_size < 56 then 2 else 3 end as branch
from part
""")
def partition_bands(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return X.with_branch(p, X.age_band("p_size"))


@query("side_input_len_band", ids=("P20", "R11"), sql="""
with w as (
  select doc_id, unnest(range(len(ws))) as pos, unnest(ws) as word
  from (select doc_id, regexp_split_to_array(t, '\\s+') as ws
        from (select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as t from documents)
        where t <> ''))
select doc_id, cast(pos as integer) as pos, word, cast(length(word) as integer) as length
from w where length(word) > 2 and length(word) < 10
""")
def side_input_len_band(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    words = X.tokens(d, "text", None, keep=["doc_id"])
    return X.length_band_filter(words, "word", 2, 10).withColumn("length", F.length("word"))


# ---------------------------------------------------------------- P18 composite


def word_frequency(min_len: int = 5):
    """Split on whitespace -> keep the leading run free of ``.|,()`` ->
    longer than ``min_len`` -> count per word, as one reusable transform."""
    def apply(df):
        words = X.tokens(df, "text", None, with_position=False)
        # Fixed value: the pattern.  It needs one character or more, so "" means "no match".
        lead = F.regexp_extract("word", r"^(?:[^.|,|(|)]+)", 0)
        clean = words.select(lead.alias("word")).filter(F.col("word") != "")
        return A.count_per_key(clean.filter(FL.longer_than("word", min_len)), "word")
    return apply


@query("composite_word_freq", ids=("P18", "X4", "F8", "A6"), headline=True, sql="""
with w as (
  select unnest(regexp_split_to_array(t, '\\s+')) as word
  from (select regexp_replace(text, '^\\s+|\\s+$', '', 'g') as t from documents) where t <> ''),
m as (select regexp_extract(word, '^(?:[^.|,|(|)]+)', 0) as word from w
      where regexp_matches(word, '^(?:[^.|,|(|)]+)'))
select word, count(*) as n from m where length(word) > 5 group by word
""")
def composite_word_freq(spark, sf_dir):
    return docs(spark, sf_dir, "text").transform(word_frequency(5))


# ---------------------------------------------------------------- F1-F12, J4, J5

# The literal word list of the membership filter.
SELECTED_WORDS = ["the", "and", "of", "le", "de", "der", "la", "und", "el"]


@query("filter_even", ids=("F1", "R20"), sql="""
select o_orderkey, o_custkey from orders where o_custkey % 2 = 0
""")
def filter_even(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.filter(FL.is_even("o_custkey"))


@query("word_count_selected", ids=("F3", "A5"), sql=f"""
select word, count(*) as n
from (select unnest(string_split(text, ' ')) as word from documents)
where word in ({", ".join("'" + w + "'" for w in SELECTED_WORDS)})
group by word
""")
def word_count_selected(spark, sf_dir):
    words = X.tokens(docs(spark, sf_dir, "text"), "text", " ")
    return A.count_per_key(words.filter(FL.in_literals("word", SELECTED_WORDS)), "word")


@query("side_input_semi", ids=("F4", "J4", "A6"), headline=True, sql="""
with v as (select distinct unnest(string_split(text, ' ')) as word from benchmark),
d as (select unnest(string_split(text, ' ')) as word from documents)
select word, count(*) as n from d where word in (select word from v) group by word
""")
def side_input_semi(spark, sf_dir):
    vocab = X.tokens(table(spark, sf_dir, "benchmark"), "text", " ").select("word").distinct()
    words = X.tokens(docs(spark, sf_dir, "text"), "text", " ").select("word")
    # Counted first: a frequent word meets the vocabulary as one row, not as all its places.
    return FL.semi_join(A.count_per_key(words, "word"), vocab, "word")


@query("side_input_anti", ids=("F5", "J5"), headline=True, sql="""
select doc_id, n_chars from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id)
""")
def side_input_anti(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    return FL.anti_join(d, labelled, "doc_id")


# Channel names removed from the news lines (F5 side input);
# the role header lines play that part in the conversations table.
CHANNELS = ["user", "assistant", "system"]
HOURS_AGO = r"^[0-9]+ (hours|hour) ago$"


def news_feed(spark, sf_dir):
    """Each conversation turn as a news block: a channel line, the text, and an
    "N hours ago" line (N = turn; "hour" when N is 1)."""
    c = table(spark, sf_dir, "conversations")
    ago = F.concat(F.col("turn").cast("string"),
                   F.when(F.col("turn") == 1, F.lit(" hour ago")).otherwise(F.lit(" hours ago")))
    return c.select("conv_id", "turn",
                    F.concat_ws("\n", F.col("role"), F.col("text"), ago).alias("block"))


@query("news_lines_clean", ids=("F5", "F6", "F7", "R22"), sql=f"""
with b as (
  select conv_id, turn,
    role || chr(10) || text || chr(10) || cast(turn as varchar) ||
      case when turn = 1 then ' hour ago' else ' hours ago' end as block
  from conversations),
l as (select conv_id, turn, unnest(range(len(ls))) as pos, unnest(ls) as line
      from (select conv_id, turn, string_split(block, chr(10)) as ls from b)),
s as (select conv_id, turn, pos, regexp_replace(line, '^\\s+|\\s+$', '', 'g') as line from l)
select conv_id, turn, cast(pos as integer) as pos, line from s
where line not in ({", ".join("'" + c + "'" for c in CHANNELS)})
  and not regexp_matches(line, '{HOURS_AGO}') and line <> ''
""")
def news_lines_clean(spark, sf_dir):
    lines = X.tokens(news_feed(spark, sf_dir), "block", "\n", out="line",
                     keep=["conv_id", "turn"])
    stripped = lines.withColumn("line", T.strip_ws("line"))
    return (stripped.filter(~FL.in_literals("line", CHANNELS))
                    .filter(FL.regex_not_match("line", HOURS_AGO))
                    .filter(F.col("line") != "")
                    .select("conv_id", "turn", "pos", "line"))


@query("array_forall", ids=("F10", "A1"), sql="""
select l_orderkey, bool_and(l_discount <> 0) as all_discounted from lineitem group by l_orderkey
""")
def array_forall(spark, sf_dir):
    return A.all_in_group(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_discount") != 0,
                          out="all_discounted")


@query("array_forall_elements", ids=("F10",), sql="""
select vec_id, len([x for x in embedding if abs(x) >= 0.25]) = 0 as all_small from embeddings
""")
def array_forall_elements(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", FL.all_elements("embedding", lambda x: F.abs(x) < 0.25).alias("all_small"))


@query("fill_null_constant", ids=("W3", "F11"), sql="""
select c_custkey, coalesce(case when c_acctbal >= 0 then c_mktsegment end, 'Unknown') as c_mktsegment
from customer
""")
def fill_null_constant(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    dirty = c.select("c_custkey", K.nullify("c_mktsegment", F.col("c_acctbal") < 0)
                     .alias("c_mktsegment"))
    return K.fill_null_constant(dirty, "c_mktsegment", "Unknown")


@query("fill_null_with_avg", ids=("W1",), sql="""
with d as (select c_custkey, case when c_acctbal >= 0 then c_acctbal end as bal from customer)
select c_custkey, cast(trunc(coalesce(bal, (select avg(bal) from d))) as integer) as bal from d
""")
def fill_null_with_avg(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    dirty = c.select("c_custkey", K.nullify("c_acctbal", F.col("c_acctbal") < 0).alias("bal"))
    return K.fill_null_with_avg(dirty, "bal")


@query("fill_null_with_group_avg", ids=("W2",), headline=True, sql="""
with d as (select c_custkey, c_mktsegment, case when c_acctbal >= 0 then c_acctbal end as bal
           from customer),
g as (select c_mktsegment, avg(bal) as a from d group by 1)
select c_custkey, d.c_mktsegment, cast(trunc(coalesce(bal, a)) as integer) as bal
from d join g using (c_mktsegment)
""")
def fill_null_with_group_avg(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    dirty = c.select("c_custkey", "c_mktsegment",
                     K.nullify("c_acctbal", F.col("c_acctbal") < 0).alias("bal"))
    return K.fill_null_with_group_avg(dirty, "bal", "c_mktsegment")


# ---------------------------------------------------------------- U1-U5, L1


def _custs_by_status(spark, sf_dir, status):
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("value"))


@query("flatten_union_all", ids=("U1",), sql="""
select c_name as name, c_nationkey as nationkey from customer
union all select s_name, s_nationkey from supplier
""")
def flatten_union_all(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"),
                                                F.col("c_nationkey").alias("nationkey"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"),
                                                F.col("s_nationkey").alias("nationkey"))
    return S.union_all(c, s)


_SETS_SQL = """
with a as (select o_custkey as value from orders where o_orderstatus = 'F'),
     b as (select o_custkey as value from orders where o_orderstatus = 'P')
"""


@query("set_intersect", ids=("U2",), sql=_SETS_SQL + "select value from a intersect select value from b")
def set_intersect(spark, sf_dir):
    return S.intersect(_custs_by_status(spark, sf_dir, "F"), _custs_by_status(spark, sf_dir, "P"))


@query("set_union", ids=("U3",), sql=_SETS_SQL + "select value from a union select value from b")
def set_union(spark, sf_dir):
    return S.union_distinct(_custs_by_status(spark, sf_dir, "F"),
                            _custs_by_status(spark, sf_dir, "P"))


@query("set_difference", ids=("U4",), sql=_SETS_SQL + "select value from b except select value from a")
def set_difference(spark, sf_dir):
    """Second set minus the first, as the reference computes it."""
    return S.difference(_custs_by_status(spark, sf_dir, "P"), _custs_by_status(spark, sf_dir, "F"))


@query("set_symmetric_difference", ids=("U5",), headline=True, sql=_SETS_SQL + """
(select value from a except select value from b) union (select value from b except select value from a)
""")
def set_symmetric_difference(spark, sf_dir):
    return S.symmetric_difference(_custs_by_status(spark, sf_dir, "F"),
                                  _custs_by_status(spark, sf_dir, "P"))


_TOPK_SQL = """
select distinct user_id, ts from events where cast(ts as date) = date '2024-01-15'
order by ts, user_id limit 100
"""


@query("sql_distinct_topk", ids=("L1", "L2", "S11", "S12", "F9"), headline=True, sql=_TOPK_SQL)
def sql_distinct_topk(spark, sf_dir):
    """The source query as SQL text over a frame: ``to_date(ts) = d`` reaches
    the parquet scan as a pushed ``>=``/``<`` range, and distinct + order +
    limit plans as a TakeOrderedAndProject (k rows per task, no full sort)."""
    from ..sources.files import sql_source
    return sql_source(spark, """
        select distinct user_id, ts from {events} where to_date(ts) = to_date(:day)
        order by ts, user_id limit 100""", {"day": "2024-01-15"}, events=table(spark, sf_dir, "events"))


@query("distinct_topk", ids=("L1", "L2", "F9"), sql=_TOPK_SQL)
def distinct_topk(spark, sf_dir):
    """The same top-k through the DataFrame operators."""
    ev = table(spark, sf_dir, "events").filter(FL.on_date("ts", "2024-01-15"))
    return S.distinct_top_k(ev.select("user_id", "ts"), [F.col("ts"), F.col("user_id")], 100)


# ---------------------------------------------------------------- R12-R24


@query("text_stats", ids=("R12",), headline=True, sql="""
select doc_id,
  cast(case when t = '' then 0 else len(regexp_split_to_array(t, '\\s+')) end as integer) as n_words,
  cast(length(regexp_replace(t, '\\s', '', 'g')) as integer) as n_chars_no_ws
from (select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as t from documents)
""")
def text_stats(spark, sf_dir):
    d = docs(spark, sf_dir, "doc_id", "text")
    stats = T.text_stats("text")
    return d.select("doc_id", *[c.alias(n) for n, c in stats.items()])


@query("format_ratio", ids=("R13", "R20"), sql="""
select doc_id, printf('%.2fh', n_chars / 60) as hours from documents
""")
def format_ratio(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.format_ratio("n_chars", 60, "%.2fh").alias("hours"))


@query("to_json_rows", ids=("R16",), sql=_GAPS_SQL + """
select c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_mktsegment': seg})::varchar as json from c
""")
def to_json_rows(spark, sf_dir):
    c = customers_with_gaps(spark, sf_dir)
    doc = F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment"), {"ignoreNullFields": "false"})
    return c.select("c_custkey", doc.alias("json"))


def _quantity_text():
    return F.format_string("[%s, %s, %s]", F.col("l_quantity").cast("string"),
                           F.col("l_discount").cast("string"), F.col("l_tax").cast("string"))


@query("string_to_array", ids=("R17",), sql="""
select l_orderkey, l_linenumber,
  cast(json('[' || cast(l_quantity as varchar) || ', ' || cast(l_discount as varchar) || ', '
       || cast(l_tax as varchar) || ']') as double[]) as numbers
from lineitem
""")
def string_to_array(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.from_json(_quantity_text(), "array<double>").alias("numbers"))


@query("scaled_columns", ids=("R19", "R20"), sql="""
select l_orderkey, l_linenumber, l_quantity * 2 as doubled, l_quantity * 3 as tripled,
       -l_quantity as negated
from lineitem
""")
def scaled_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.scaled("l_quantity", 2.0).alias("doubled"),
                     X.scaled("l_quantity", 3.0).alias("tripled"),
                     (-F.col("l_quantity")).alias("negated"))


@query("bytes_to_text", ids=("R21",), sql="""
select event_id, cast(octet_length(encode(props)) as integer) as n_bytes,
       decode(encode(props)) as text
from events
""")
def bytes_to_text(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    b = ev.select("event_id", F.encode("props", "UTF-8").alias("payload"))
    return b.select("event_id", F.length("payload").alias("n_bytes"),
                    F.decode("payload", "UTF-8").alias("text"))


@query("zip_to_map", ids=("R23",), sql=_GAPS_SQL + """
select c_custkey,
  to_json(map(['id', 'name', 'segment'], [cast(c_custkey as varchar), c_name, seg]))::varchar as record
from c
""")
def zip_to_map(spark, sf_dir):
    c = customers_with_gaps(spark, sf_dir)
    header = F.array(F.lit("id"), F.lit("name"), F.lit("segment"))
    vals = F.array(F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"))
    record = F.to_json(F.map_from_arrays(header, vals), {"ignoreNullFields": "false"})
    return c.select("c_custkey", record.alias("record"))


@query("epoch_seconds", ids=("R24",), sql="""
select event_id, epoch_us(ts) // 1000000 as epoch_s, epoch_us(ts) as epoch_us from events
""")
def epoch_seconds(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", T.epoch_seconds_ntz("ts").alias("epoch_s"),
                     T.epoch_micros_ntz("ts").alias("epoch_us"))


@query("event_time_label", ids=("P21", "R24"), sql="""
select event_id, strftime(make_timestamp((epoch_us(ts) // 1000000) * 1000000), '%Y-%m-%d %H:%M:%S')
       || '-' || event_type as label
from events
""")
def event_time_label(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id",
                     T.event_time_label(T.epoch_seconds_ntz("ts"), "event_type").alias("label"))


@query("processing_time_label", ids=("P21", "P15"), sql="""
select event_id, '2024-03-01 12:30:00-' || event_type as label from events
""")
def processing_time_label(spark, sf_dir):
    """P21 processing-time form: ``"<now>-<name>"``, with the clock as an argument."""
    now = F.to_timestamp_ntz(F.lit("2024-03-01 12:30:00"))
    ev = K.with_processed_at(table(spark, sf_dir, "events"), "now", at=now)
    return ev.select("event_id", F.concat_ws("-", T.python_datetime_str("now"), T.py_str("event_type")).alias("label"))


@query("logical_clock_label", ids=("P21",), sql="""
select event_id, cast(event_id as varchar) || '-' || event_type as label from events
""")
def logical_clock_label(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", T.logical_clock_label("event_id", "event_type").alias("label"))
