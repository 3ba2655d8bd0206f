"""Regex transforms with the semantics of a pipeline-SDK ``Regex`` catalogue.

"matches" forms are anchored at the start of the text (Python ``re.match``),
"find" forms search anywhere (``re.search`` / ``finditer``).  Every form is a
built-in Java-regex expression; patterns should keep to the subset shared by
Java regex and RE2 so the DuckDB oracle agrees (``\\d`` written ``[0-9]``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def anchored(pattern: str) -> str:
    """``re.match`` anchoring: the match must start at offset 0."""
    return f"^(?:{pattern})"


def group_count(pattern: str) -> int:
    """Number of capture groups (pattern metadata only, no data)."""
    return re.compile(pattern).groups


def matches(df: DataFrame, col: str, pattern: str, group: int = 0,
            out: str = "match") -> DataFrame:
    """Keep rows whose text matches at the start; emit that group."""
    p = anchored(pattern)
    return (df.filter(_c(col).rlike(p))
              .select(F.regexp_extract(_c(col), p, group).alias(out), *_rest(df, col)))


def all_matches(df: DataFrame, col: str, pattern: str, out: str = "groups") -> DataFrame:
    """R2: anchored match -> list of groups 0..n (n = groups in the pattern).

    Python stops the list at the last group that took part in the match
    (``lastindex``) and gives None for skipped groups; Java's extraction
    gives "" for a group that did not take part, so the two differ only for
    patterns with optional trailing groups."""
    p = anchored(pattern)
    n = group_count(pattern)
    groups = F.array(*[F.regexp_extract(_c(col), p, i) for i in range(n + 1)])
    return df.filter(_c(col).rlike(p)).select(groups.alias(out), *_rest(df, col))


def matches_kv(df: DataFrame, col: str, pattern: str, key_group: int,
               value_group: int = 0, key: str = "key", value: str = "value") -> DataFrame:
    """Anchored match -> (group key_group, group value_group)."""
    p = anchored(pattern)
    return (df.filter(_c(col).rlike(p))
              .select(F.regexp_extract(_c(col), p, key_group).alias(key),
                      F.regexp_extract(_c(col), p, value_group).alias(value),
                      *_rest(df, col)))


def find(df: DataFrame, col: str, pattern: str, group: int = 0,
         out: str = "match") -> DataFrame:
    """First match anywhere; rows without a match are dropped."""
    return (df.filter(_c(col).rlike(pattern))
              .select(F.regexp_extract(_c(col), pattern, group).alias(out),
                      *_rest(df, col)))


def find_all(df: DataFrame, col: str, pattern: str, group: int = 0,
             out: str = "matches") -> DataFrame:
    """List of every match (empty list kept, as the catalogue does)."""
    return df.select(F.regexp_extract_all(_c(col), F.lit(pattern), group).alias(out),
                     *_rest(df, col))


def find_kv(df: DataFrame, col: str, pattern: str, key_group: int,
            value_group: int = 0, key: str = "key", value: str = "value") -> DataFrame:
    """One (key group, value group) row per match anywhere in the text."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(_c(col), F.lit(pattern), key_group).alias("k"),
        F.regexp_extract_all(_c(col), F.lit(pattern), value_group).alias("v"))
    return (df.select(F.posexplode(pairs).alias("match_pos", "kv"), *_rest(df, col))
              .select(F.col("kv.k").alias(key), F.col("kv.v").alias(value),
                      "match_pos", *_rest(df, col)))


def _java_replacement(replacement: str) -> str:
    """Literal replacement text for Java's ``Matcher.replaceAll``."""
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def replace_all(col, pattern: str, replacement: str) -> Column:
    """Replace every match with a literal."""
    return F.regexp_replace(_c(col), pattern, _java_replacement(replacement))


def replace_first(col, pattern: str, replacement: str) -> Column:
    """Replace only the first match with a literal.

    The pattern stays as the user wrote it (its flags, ``.`` and
    back-references keep their meaning): the text is cut once at the first
    match and put together around the replacement.  A first match of length
    zero is found by its position instead (``split`` skips it).
    """
    c = _c(col)
    parts = F.split(c, pattern, 2)
    at = F.regexp_instr(c, F.lit(pattern))
    spliced = F.concat(parts[0], F.lit(replacement), parts[1])
    inserted = F.concat(F.substring(c, F.lit(1), at - 1), F.lit(replacement), F.substring(c, at, F.length(c)))
    return F.when(~c.rlike(pattern), c).when(F.regexp_extract(c, pattern, 0) == "", inserted).otherwise(spliced)


def split(col, pattern: str) -> Column:
    """Split on a regex, empty strings removed."""
    return F.filter(F.split(_c(col), pattern), lambda x: x != F.lit(""))


def _rest(df: DataFrame, col: str) -> list[str]:
    return [c for c in df.columns if c != col]
