"""File and SQL sources.

Declared schemas are preferred everywhere (no inference pass over the data);
inference is used only where the caller asks for it (S9).  All readers are
splittable per file, except multi-line JSON, which is parallel across files
only; JSON Lines is the scale path for JSON.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3: one row per line, column ``value``."""
    return spark.read.text(path)


def positional_schema(names: Sequence[str]) -> StructType:
    """An external header list as an all-string schema."""
    return StructType([StructField(n, StringType(), True) for n in names])


def read_csv_positional(spark: SparkSession, path: str, names: Sequence[str],
                        skip_header: bool = True, sep: str = ",") -> DataFrame:
    """Header line skipped, fields zipped by position to ``names``.

    Extra fields are dropped and short rows get NULL (CSV PERMISSIVE mode);
    quoted separators are parsed as CSV, unlike a plain ``split(',')``.
    """
    return (spark.read.schema(positional_schema(names))
            .option("header", skip_header).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def read_csv_typed(spark: SparkSession, path: str, schema, header: bool = True,
                   sep: str = ",") -> DataFrame:
    """Header + declared schema (DDL text or StructType)."""
    return spark.read.csv(path, header=header, schema=schema, sep=sep)


def read_csv_untyped(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header, every column a string; types are fixed later."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header + inferred schema (one extra pass over the input)."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("sep", sep).csv(path))


def read_json_array(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Each file is one JSON array; one row per element."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON Lines: splittable, the scale form of S10."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def sql_source(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL over frames, named in the text as ``{name}``; values go in
    as ``:marker`` arguments.  No session-wide view is left behind."""
    return spark.sql(sql, args=args, **frames) if args else spark.sql(sql, **frames)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """The input file of each row (for ingest audits)."""
    return df.withColumn(name, F.input_file_name())
