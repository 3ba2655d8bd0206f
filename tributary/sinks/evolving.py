"""Append with an autodetected schema that may change.

JSON documents are typed by what they hold: ``schema_of_variant_agg`` merges the
schemas of all documents of a load in one distributed aggregate (no sampling).
A table keeps one folder per schema that was ever appended; nothing stored is
rewritten when a later load brings other fields or types.  Reading brings all
folders to one schema:

* a field that a load lacks is NULL in its rows;
* whole numbers and fractions meet as DOUBLE, dates and timestamps as
  TIMESTAMP, structs field by field, arrays by their elements;
* anything else meets as STRING (nested values as JSON text).

Field names are taken as written; two that differ only in case are refused, as
Spark's tables would confuse them.  A document that is no JSON object counts
as a reject and gives no row; a load without documents changes nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import is_json_object

_NAMES = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bVARIANT\b|\bVOID\b|\bDECIMAL\(\d+, ?\d+\)|\bTIMESTAMP_NTZ\b")
_SQL = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING", "TIMESTAMP_NTZ": "TIMESTAMP"}


def detect(docs: DataFrame, text: str) -> T.StructType | None:
    """The schema that holds all JSON objects of a column; None without any."""
    found = docs.where(is_json_object(text)).agg(F.schema_of_variant_agg(F.try_parse_json(text)).alias("s")).first()
    if found is None or not found.s.startswith("OBJECT<"):
        return None
    inner = _NAMES.sub(lambda m: _SQL.get(m[0], m[0] if m[0][0] == "`" else "DOUBLE"), found.s)
    return T.DataType.fromDDL(inner)


def parse_autodetected(docs: DataFrame, text: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The JSON objects of a column as typed rows; None without any."""
    schema = schema or detect(docs, text)
    if schema is None or not len(schema):
        return None
    return docs.where(is_json_object(text)).select(F.from_json(text, schema).alias("j")).select("j.*")


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that both meet as."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    return T.StringType()


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of both, those of ``a`` first, each wide enough for both."""
    own = {f.name: f.dataType for f in a}
    for f in b:
        own[f.name] = widened(own[f.name], f.dataType) if f.name in own else f.dataType
    lower = [n.lower() for n in own]
    if len(set(lower)) < len(lower):
        raise ValueError(f"fields that differ in case only: {sorted(n for n in own if lower.count(n.lower()) > 1)}")
    return T.StructType([T.StructField(n, t) for n, t in own.items()])


def brought(value: Column, a: T.DataType, b: T.DataType) -> Column:
    """A value of type ``a`` as its widened type ``b``."""
    if a == b:
        return value
    if isinstance(b, T.StringType):
        return F.to_json(value) if isinstance(a, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return F.transform(value, lambda x: brought(x, a.elementType, b.elementType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        own = {f.name: f.dataType for f in a}
        fields = [(brought(value[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in b]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast(b)


def schema_folder(schema: T.StructType, stored: Iterable[str]) -> str:
    """The folder of a schema among the ``stored`` ones, or the next new one: a
    number and a digest of its names and types (nullability aside)."""
    digest = hashlib.sha256(schema.simpleString().encode()).hexdigest()[:16]
    names = [s.rsplit("/", 1)[-1] for s in stored]
    return next((n for n in names if n.endswith(digest)), f"schema-{len(names) + 1:06d}-{digest}")


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows of any schema to the table under ``path``."""
    stored = schemas(df.sparkSession, path)
    reduce(merged, [*stored.values(), df.schema])  # a clash is refused before anything is written
    df.write.mode("append").parquet(f"{path.rstrip('/')}/{schema_folder(df.schema, stored)}")


def append_documents(docs: DataFrame, text: str, path: str) -> None:
    """K2: append the JSON objects of a column with their autodetected schema."""
    rows = parse_autodetected(docs, text)
    if rows is not None:
        append_evolving(rows, path)


def schemas(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """The folders of a table (one per schema ever appended) and their schemas,
    in the order in which they were made."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    marked = []
    for s in fs.listStatus(p):
        if s.isDirectory() and s.getPath().getName().startswith("schema-"):
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
            if fs.exists(done):
                marked.append(s.getPath().toString())
    return {name: spark.read.parquet(name).schema for name in sorted(marked)}


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """The whole table under one schema, wide enough for every load."""
    found = schemas(spark, path)
    if not found:
        raise FileNotFoundError(path)
    whole = reduce(merged, found.values())
    parts = []
    for name, schema in found.items():
        own = {f.name: f.dataType for f in schema}
        parts.append(spark.read.parquet(name).select(*[
            (brought(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in whole]))
    return reduce(DataFrame.unionByName, parts)
