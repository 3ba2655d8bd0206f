"""Regex catalogue queries over the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import regex as RX
from ..session import spread
from .registry import query, table

# The catalogue's pattern, with ``\d`` written ``[0-9]`` (the
# form Java regex and RE2 read alike), and an anchored two-word pattern.
FIND_PATTERN = r"([a-d][a-d]|[0-9]+)"
LEAD_PATTERN = r"([A-Za-z]+) ([a-z]+)"


def _docs(spark, sf_dir):
    """The documents' id and text, spread over the task slots for the regex work."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("regex_matches", ids=("R1",), sql=f"""
select doc_id, regexp_extract(text, '^(?:{LEAD_PATTERN})', 0) as match
from documents where regexp_matches(text, '^(?:{LEAD_PATTERN})')
""")
def regex_matches(spark, sf_dir):
    return RX.matches(_docs(spark, sf_dir), "text", LEAD_PATTERN)


@query("regex_all_matches", ids=("R2",), sql=f"""
select doc_id, [regexp_extract(text, '^(?:{LEAD_PATTERN})', 0),
                regexp_extract(text, '^(?:{LEAD_PATTERN})', 1),
                regexp_extract(text, '^(?:{LEAD_PATTERN})', 2)] as groups
from documents where regexp_matches(text, '^(?:{LEAD_PATTERN})')
""")
def regex_all_matches(spark, sf_dir):
    return RX.all_matches(_docs(spark, sf_dir), "text", LEAD_PATTERN)


@query("regex_matches_kv", ids=("R3",), sql=f"""
select doc_id, regexp_extract(text, '^(?:{LEAD_PATTERN})', 1) as key,
       regexp_extract(text, '^(?:{LEAD_PATTERN})', 0) as value
from documents where regexp_matches(text, '^(?:{LEAD_PATTERN})')
""")
def regex_matches_kv(spark, sf_dir):
    return RX.matches_kv(_docs(spark, sf_dir), "text", LEAD_PATTERN, key_group=1)


@query("regex_find", ids=("R4",), sql=f"""
select doc_id, regexp_extract(text, '{FIND_PATTERN}', 0) as match
from documents where regexp_matches(text, '{FIND_PATTERN}')
""")
def regex_find(spark, sf_dir):
    return RX.find(_docs(spark, sf_dir), "text", FIND_PATTERN)


@query("regex_find_all", ids=("R5",), sql=f"""
select doc_id, regexp_extract_all(text, '{FIND_PATTERN}', 0) as matches from documents
""")
def regex_find_all(spark, sf_dir):
    return RX.find_all(_docs(spark, sf_dir), "text", FIND_PATTERN)


@query("regex_find_kv", ids=("R6",), headline=True, sql=f"""
select doc_id, cast(pos as integer) as match_pos, k as key, v as value
from (select doc_id, unnest(range(len(ks))) as pos, unnest(ks) as k, unnest(vs) as v
      from (select doc_id, regexp_extract_all(text, '{FIND_PATTERN}', 1) as ks,
                   regexp_extract_all(text, '{FIND_PATTERN}', 0) as vs from documents))
""")
def regex_find_kv(spark, sf_dir):
    return RX.find_kv(_docs(spark, sf_dir), "text", FIND_PATTERN, key_group=1)


@query("regex_replace_all", ids=("R7",), sql="""
select doc_id, regexp_replace(text, '\\s', ',', 'g') as replaced from documents
""")
def regex_replace_all(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", RX.replace_all("text", r"\s", ",").alias("replaced"))


@query("regex_replace_first", ids=("R8",), sql="""
select doc_id, regexp_replace(text, '\\s', ',') as replaced from documents
""")
def regex_replace_first(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", RX.replace_first("text", r"\s", ",").alias("replaced"))


@query("regex_split", ids=("R9",), sql="""
select doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') as pieces from documents
""")
def regex_split(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", RX.split("text", " ").alias("pieces"))


@query("regex_word_lengths", ids=("R5", "A6"), sql=f"""
select m as match, count(*) as n
from (select unnest(regexp_extract_all(text, '{FIND_PATTERN}', 0)) as m from documents)
group by m
""")
def regex_word_lengths(spark, sf_dir):
    """Counts of every match of the catalogue pattern over the whole corpus."""
    d = _docs(spark, sf_dir)
    m = d.select(F.explode(F.regexp_extract_all("text", F.lit(FIND_PATTERN), 0)).alias("match"))
    return m.groupBy("match").agg(F.count(F.lit(1)).alias("n"))
