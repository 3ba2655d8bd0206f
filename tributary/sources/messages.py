"""A replayable message log and its stream source.

A log is a folder of published batches, each a numbered folder of Parquet files;
the place of a message in the log is its offset, from 0 in the order of
publication.  ``MessageSource`` is a Spark data source that streams a log as a
broker would:

* offsets: a micro-batch is a range of offsets; Spark's checkpoint keeps them,
  so a restart goes on where the last planned batch ended, and a batch that
  was planned but not finished is read again exactly;
* partitions: a range is cut at files and at ``rowsPerTask`` messages, each part
  read by one task from the row groups that hold it;
* admission control: a micro-batch takes at most ``maxRowsPerTrigger`` messages,
  however long the backlog is.  The position is taken up from the query's
  checkpoint (option ``checkpoint``), where Spark has noted the last range.

Log and checkpoint must lie where Python reaches them: a folder mounted on all
machines.  Only file names and row counts pass through the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_path

# The reader runs in Python workers: ship it by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "message_log"
OFFSET = "offset"


def local_path(path: str) -> str:
    """The path as Python opens it; other file systems than a mounted one are refused."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"{path}: a message log must lie on a mounted file system")
    return unquote(parsed.path) if parsed.scheme else path


def publish(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Append one batch to the log: its messages get the next offsets, in
    ``order`` (files hold consecutive ranges of it)."""
    done = [int(n) for n in _batches(local_path(path))]
    step = f"{path.rstrip('/')}/{max(done, default=0) + 1:08d}"
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(step)


def _batches(path: str) -> list[str]:
    """The published batches in order; one that is still written has no mark."""
    names = os.listdir(path) if os.path.isdir(path) else []
    return sorted(n for n in names if os.path.exists(os.path.join(path, n, "_SUCCESS")))


class Range(InputPartition):
    """``rows`` messages of a file from row ``first``; ``offset`` is the first one's."""

    def __init__(self, file: str, first: int, rows: int, offset: int) -> None:
        super().__init__((file, first, rows, offset))
        self.file, self.first, self.rows, self.offset = file, first, rows, offset


class MessageReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema = schema
        self.path = local_path(options["path"])
        self.rows = int(options.get("maxrowspertrigger", 1 << 62))
        self.per_task = int(options.get("rowspertask", 1 << 20))
        self.known: dict[str, int] = {}
        self.seen = planned_offset(options["checkpoint"]) if options.get("checkpoint") else 0

    def _files(self) -> Iterator[tuple[str, int]]:
        for batch in _batches(self.path):
            folder = os.path.join(self.path, batch)
            for name in sorted(n for n in os.listdir(folder) if n.endswith(".parquet")):
                file = os.path.join(folder, name)
                if file not in self.known:
                    self.known[file] = pq.read_metadata(file).num_rows
                yield file, self.known[file]

    def initialOffset(self) -> dict:
        return {OFFSET: 0}

    def latestOffset(self) -> dict:
        end = sum(rows for _, rows in self._files())
        self.seen = max(self.seen, min(end, self.seen + self.rows))
        return {OFFSET: self.seen}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        found, at = [], 0
        for file, rows in self._files():
            low, high = max(start[OFFSET], at), min(end[OFFSET], at + rows)
            found += [Range(file, o - at, min(self.per_task, high - o), o) for o in range(low, high, self.per_task)]
            at += rows
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        columns = [n for n in schema.names if n != OFFSET]
        with pq.ParquetFile(partition.file) as file:
            at, first, end = 0, partition.first, partition.first + partition.rows
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if at < end and at + rows > first:
                    held = file.read_row_group(group, columns=columns).slice(max(0, first - at), min(end, at + rows) - max(first, at))
                    offset = partition.offset + max(0, at - first)
                    offsets = pa.array(range(offset, offset + held.num_rows), pa.int64())
                    held = held.append_column(OFFSET, offsets).select(schema.names).cast(schema)
                    yield from held.to_batches(max_chunksize=10_000)
                at += rows


class MessageSource(DataSource):
    """``spark.readStream.format("message_log")``: the messages' own columns
    and ``offset``; register it with ``stream`` below."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.options["columns"]))

    def streamReader(self, schema: StructType) -> MessageReader:
        return MessageReader(schema, dict(self.options))


def planned_offset(checkpoint: str) -> int:
    """The end of the last range that a query has planned, from its checkpoint."""
    folder = os.path.join(local_path(checkpoint), "offsets")
    numbers = [int(n) for n in os.listdir(folder) if n.isdigit()] if os.path.isdir(folder) else []
    for number in sorted(numbers, reverse=True):
        with open(os.path.join(folder, str(number)), encoding="utf-8") as f:
            for line in f.read().split("\n")[2:]:
                offset = json.loads(line).get(OFFSET) if line.startswith("{") else None
                if offset is not None:
                    return int(offset)
    return 0


def stream(spark: SparkSession, path: str, schema: StructType, checkpoint: str, max_rows_per_trigger: int | None = None,
           rows_per_task: int | None = None) -> DataFrame:
    """The log as a stream of ``schema`` and ``offset``, to be run with
    ``checkpoint`` as its checkpoint location."""
    spark.dataSource.register(MessageSource)
    whole = StructType([*schema.fields, StructField(OFFSET, LongType(), False)])
    reader = spark.readStream.format(FORMAT).option("columns", whole.json()).option("checkpoint", checkpoint)
    for name, value in (("maxRowsPerTrigger", max_rows_per_trigger), ("rowsPerTask", rows_per_task)):
        if value:
            reader = reader.option(name, value)
    return reader.load(path)


def end_offset(path: str) -> int:
    """The offset of the next message to be published."""
    return sum(rows for _, rows in MessageReader(StructType([]), {"path": path})._files())


def listen(messages: DataFrame, name: str, checkpoint: str, output: str | None = None, until: int | None = None,
           seconds: float = 600, fmt: str = "parquet") -> str:
    """Append the stream to a file sink until the offset ``until`` is
    reached, ``seconds`` at most, then stop cleanly.  Returns the output path."""
    output = output or scratch_path(messages.sparkSession, f"{name}_out")
    query = (messages.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(processingTime="0 seconds").start(output))
    ends = time.monotonic() + seconds
    try:
        while query.isActive and time.monotonic() < ends:
            if until is not None and committed_offset(checkpoint) >= until:
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return output


def committed_offset(checkpoint: str) -> int:
    """The end of the last range that a query has finished."""
    root = local_path(checkpoint)
    done = os.path.join(root, "commits")
    numbers = [int(n) for n in os.listdir(done) if n.isdigit()] if os.path.isdir(done) else []
    if not numbers:
        return 0
    with open(os.path.join(root, "offsets", str(max(numbers))), encoding="utf-8") as f:
        return next(int(json.loads(x)[OFFSET]) for x in f.read().split("\n")[2:] if x.startswith("{"))
