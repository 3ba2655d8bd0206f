"""The corpus pipeline: five stages, each one of the numbered operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import decontaminate, mixing, quality, simhash
from tributary.llm.queries import token_rows
from tributary.plans.registry import table
from tributary.session import discard, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules call good."""
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document taken twice comes twice."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in ORC, and per row what the files say about it.  The workers
    have served other stages before: a smaller memory than the operator's own."""
    return token_rows(spark, docs, memory_units=150_000, group_bytes=2 << 20)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_decontamination), ("source_mixing", source_mixing),
          ("token_output", token_output)]

#: SimHash, tokenizers and weak supervision are beyond SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
