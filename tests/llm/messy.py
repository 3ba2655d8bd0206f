"""Small frames with everything the operators must survive."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, res string, "
              "n_words int, shards string, fingerprint string, m_block int, k_id int, label string")

WORDS = ("the of and river stone quick brown fox jumps over lazy dog while morning light falls on water "
         "a small boat drifts past old mills where people used to grind their corn into flour").split()


def prose(seed: int, n: int) -> str:
    """Clean prose: sentences of a few words."""
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(("", "ly", "er", "ing", "s", "est")) + rng.choice(("", "a", "o", "u"))
             for _ in range(n)]
    for i in range(7, n, 8):
        words[i] += "."
    return " ".join(words)


def messy_rows() -> list[tuple]:
    long = prose(99, 30_000)
    texts = [
        (1, prose(1, 120), "src0"), (2, prose(1, 120), "src0"), (3, prose(3, 80), None), (4, None, "src1"),
        (5, "", "src1"), (6, " \t\n ", "src0"), (None, prose(7, 60), "src2"), (8, prose(8, 90), "src2"),
        (8, prose(8, 90), "src2"), (8, prose(9, 90), "src2"), (10, "naïve Ünïcode  double  spaces  x 😀\r\n\r\n\x0b\x0c end ", "é"),
        (11, long, "src0"), (12, "one two three", ""), (13, "\\ [x] <|im_end|> \x00 nul", "src0"),
        (14, prose(1, 119) + " changed", "src0"), (15, "word " * 50, "src0"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), "r", "s", 7, "x", "f", 3, 2, "l") for i, t, s in texts]


def messy(spark):
    return spark.createDataFrame(messy_rows(), DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def same_rows(a, b) -> bool:
    """Whether two frames hold the same rows, repeats counted."""
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def hot(spark, n: int = 600):
    """A third of the rows are copies of one text, a third near copies."""
    base = prose(5, 150)
    rows = []
    for i in range(n):
        text = base if i % 3 == 0 else base + f" tail{i}" if i % 3 == 1 else prose(1000 + i, 60)
        rows.append((i, text, "en", "src0" if i % 3 else "src1", len(text)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        5, F.col("doc_id"))
