"""Sinks.

Writers are plain ``DataFrameWriter`` calls with the mode made explicit.
Declared schemas are checked and cast before an append so a table never drifts.
Display helpers only ever fetch a bounded number of rows.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..session import discard, materialize, scratch_path

# Type names of the "name:TYPE,..." sink schema text and their
# Spark equivalents.
SINK_TYPES = {
    "STRING": "string", "INTEGER": "bigint", "INT64": "bigint", "INT": "int",
    "FLOAT": "double", "FLOAT64": "double", "NUMERIC": "decimal(38,9)",
    "BOOLEAN": "boolean", "BOOL": "boolean", "TIMESTAMP": "timestamp",
    "DATE": "date", "DATETIME": "timestamp_ntz",
}


def parse_sink_schema(text: str) -> list[tuple[str, str]]:
    """``"name:TYPE,name:TYPE"`` -> [(name, spark type)]."""
    out = []
    for part in text.split(","):
        name, _, typ = part.strip().partition(":")
        spark_type = SINK_TYPES.get(typ.strip().upper())
        if not name or spark_type is None:
            raise ValueError(f"bad sink schema field {part!r}")
        out.append((name.strip(), spark_type))
    return out


def _ddl(schema: str) -> StructType | None:
    try:
        return StructType.fromDDL(schema)
    except ParseException:
        return None


def conform(df: DataFrame, schema) -> DataFrame:
    """Select and cast to a declared schema (DDL, sink text or StructType).

    Text in which every field is ``name:TYPE`` with a sink type is sink text
    (its ``INTEGER`` is 64 bits wide); all other text is DDL, nested types
    included.  Missing columns fail; extra columns are dropped.
    """
    if isinstance(schema, StructType):
        fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    else:
        try:
            fields = parse_sink_schema(schema)
        except ValueError:
            st = _ddl(schema)
            if st is None:
                raise
            fields = [(f.name, f.dataType.simpleString()) for f in st.fields]
    missing = [n for n, _ in fields if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the declared schema: {missing}")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def append_declared(df: DataFrame, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """K1: append with a declared schema; the target is created if needed."""
    out = conform(df, schema)
    out.write.mode("append").format(fmt).save(path)
    return out


def target_types(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, DataType]:
    """Column types of a stored table; empty where the path does not exist (any
    other read error is raised)."""
    try:
        return {f.name: f.dataType for f in spark.read.format(fmt).load(path).schema}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def append_autodetect(spark: SparkSession, df: DataFrame, path: str,
                      fmt: str = "parquet") -> None:
    """K2: append with the frame's own schema; an existing target must have the
    same columns with the same types (names in any order)."""
    target, own = target_types(spark, path, fmt), {f.name: f.dataType for f in df.schema}
    if target and target != own:
        differing = {n: (target.get(n), own.get(n)) for n in {*target, *own} if target.get(n) != own.get(n)}
        raise ValueError(f"columns differ from the target (target, frame): {differing}")
    df.select(*(target or own)).write.mode("append").format(fmt).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K3 truncate-and-load."""
    df.write.mode("overwrite").format(fmt).save(path)


def replace_table_as_select(df: DataFrame, table_name: str, path: str | None = None) -> DataFrame:
    """K4 ``CREATE OR REPLACE TABLE ... AS SELECT`` in the session catalog; the
    files go under ``path`` (default: the shared scratch folder)."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("path", path or scratch_path(spark, table_name)).saveAsTable(table_name)
    return spark.table(table_name)


def save_default_mode(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """K5: Spark's default mode (error if the target exists)."""
    df.write.format(fmt).options(**options).save(path)


def append_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """K6."""
    df.write.mode("append").option("header", header).option("sep", sep).csv(path)


def write_text_lines(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite",
                     null_text: str = "") -> None:
    """K7: one line per row, fields joined (the text sink takes one column).
    A NULL field is written as ``null_text``, so columns never shift."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: JSON documents one per line; NULL fields are kept as ``null``."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite", one_file: bool = False) -> None:
    """Files that each hold one JSON array, a document per line.  Every task
    streams its rows between the brackets of its own file.  With ``one_file``
    all tasks make the documents' texts, and one task only copies them."""
    def brackets(batches):
        first = True
        for batch in batches:
            docs = batch.column(0)
            if first and len(docs):
                yield pa.RecordBatch.from_pydict({"value": ["[" + docs[0].as_py()]})
                docs, first = docs.slice(1), False
            yield pa.RecordBatch.from_pydict({"value": pc.binary_join_element_wise(",", docs, "")})
        yield pa.RecordBatch.from_pydict({"value": ["[]" if first else "]"]})

    docs = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    stored = materialize(docs, "json-texts") if one_file else docs
    texts = stored.coalesce(1) if one_file else docs
    texts.mapInArrow(brackets, "value string").write.mode(mode).text(path)
    discard(stored)


def show_rows(df: DataFrame, n: int = 20) -> list:
    """Fetch at most ``n`` rows for display."""
    return df.limit(n).collect()


def tap(df: DataFrame, name: str, **metrics) -> DataFrame:
    """K11 message tap: named metrics collected with the job (no per-row
    logging, no extra pass).  Read them from an ``Observation`` or listener."""
    exprs = [c.alias(k) for k, c in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(name, *exprs)
