"""Whole-text kernels over Arrow batches, and the byte-level word rules.

``map_texts`` runs a Python kernel over every text of a column.  The caller's
columns travel beside the text inside one struct, so a column named like a
result column (or like the text) cannot clash.  Nothing is shuffled: Spark's
scan decides the tasks, a lost executor only repeats its own splits.
"""

from __future__ import annotations

import re
import sys
import threading
import types
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are handed to a kernel in groups of about this many bytes (a longer
#: single text is a group of its own and stays whole).
GROUP_BYTES = 1 << 20
BATCH_BYTES = 8 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ALNUM = bytes(c + 32 if 65 <= c <= 90
               else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))


def space_words(text: bytes | None) -> list[bytes]:
    """Runs of bytes outside 0x20 and 0x09-0x0D (none for null)."""
    return text.split() if text else []


def lower_space_words(text: bytes | None) -> list[bytes]:
    """``space_words`` of the text with A-Z lower-cased."""
    return text.translate(_LOWER).split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased.

    A UTF-8 byte of 0x80 or more always belongs to a non-ASCII character, so
    the rule can be applied byte by byte.
    """
    return text.translate(_ALNUM).split() if text else []


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def byte_groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive slices of ``texts`` of about ``limit`` bytes, one text at least."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


@contextmanager
def kept_in_worker(key, make, idle_seconds: float = 2.0):
    """An object that the next task of this Python worker finds again, if it
    comes within ``idle_seconds``: an idle worker gives its memory back."""
    kept = sys.modules.setdefault("_tributary_kept", types.ModuleType("_tributary_kept")).__dict__
    found = kept.pop(key, None)
    if found:
        found[1].cancel()
    held = found[0] if found else make()
    try:
        yield held
    finally:
        timer = threading.Timer(idle_seconds, kept.pop, (key, None))
        timer.daemon = True
        kept[key] = (held, timer)
        timer.start()


def bound_batches(spark: SparkSession) -> None:
    """Spark hands a Python worker Arrow batches of up to 64 MB, held on both
    sides: for whole texts the session's bound is lowered once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(re.match(r"-?\d+", spark.conf.get(key))[0])
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


Kernel = Callable[[list[bytes | None]], list[pa.Array]]


def map_texts(df: DataFrame, text: str | Column, make_kernel: Callable[[], Kernel],
              result: T.StructType, keep: Sequence[str | Column] | None = None,
              group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``row`` (struct of the kept columns, all by default) and ``res`` per row.

    ``make_kernel`` is called once per task and returns the kernel, which
    takes a list of texts (bytes or None) and returns one Arrow array per
    field of ``result``.
    """
    bound_batches(df.sparkSession)
    kept = F.struct("*") if keep is None else F.struct(*keep)
    packed = df.select(kept.alias("row"))
    row_type, place = packed.schema["row"].dataType, None
    if isinstance(text, str) and text in row_type.fieldNames() and isinstance(row_type[text].dataType, T.StringType):
        place = row_type.fieldNames().index(text)  # the text is in the row already
    else:
        column = F.col(text) if isinstance(text, str) else text
        packed = df.select(kept.alias("row"), column.cast("string").alias("text"))
    out = T.StructType([T.StructField("row", row_type), T.StructField("res", result)])
    names = result.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make_kernel()
        for batch in batches:
            texts = batch.column(1) if place is None else batch.column(0).field(place)
            for a, b in byte_groups(texts, group_bytes):
                res = pa.StructArray.from_arrays(kernel(text_bytes(texts.slice(a, b - a))), names=names)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), res],
                                                 names=["row", "res"])
            del batch, texts
            pa.default_memory_pool().release_unused()  # workers of a core may outlive their stage

    return packed.mapInArrow(run, out)
