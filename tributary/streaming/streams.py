"""Structured Streaming sources, event time and run-to-end helpers
(SURVEY S13-S15, T1, T8-T11).

Streams read files (the driver's stand-in for a message broker; a Kafka
source is ``format("kafka")`` with the same downstream code), carry event time
as a real TIMESTAMP column with a watermark, and write to a file sink or
``foreachBatch`` with a checkpoint under the shared checkpoint folder, so a
restarted job resumes from its offsets and state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.clean import is_json_object
from ..session import scratch_path


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None,
                clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Stream the files that appear under ``path`` (a directory or
    glob).  ``clean_source`` = ``archive`` moves processed files to
    ``archive_dir``; ``delete`` removes them."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """S13 message broker source (needs the Kafka connector on the classpath):
    rows of ``key``/``value`` BINARY plus offsets."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def with_event_time(df: DataFrame, ts: str, delay: str, out: str = "event_time") -> DataFrame:
    """Event time as a TIMESTAMP column with a watermark.

    ``withWatermark`` rejects TIMESTAMP_NTZ, so NTZ input is read as UTC
    (session-zone free).  Rows later than the watermark are dropped by the
    stateful operators downstream, as the reference's defaults do.
    """
    dtype = df.schema[ts].dataType.simpleString()
    col = T.ntz_to_ltz(ts) if dtype == "timestamp_ntz" else F.col(ts)
    return df.withColumn(out, col).withWatermark(out, delay)


def decode_utf8(df: DataFrame, col: str = "value", out: str = "text") -> DataFrame:
    """Message bytes -> text."""
    return df.withColumn(out, F.decode(F.col(col), "UTF-8"))


def run_to_files(stream: DataFrame, name: str, output_mode: str = "append",
                 fmt: str = "parquet", checkpoint: str | None = None,
                 output: str | None = None, shards: int | None = None,
                 progress: list | None = None) -> str:
    """Run a streaming query over everything available now, then stop.

    Append mode writes to the file sink (exactly-once through its log);
    complete mode goes through ``foreachBatch`` overwrite, which is idempotent
    per batch.  Update mode has no file form (each batch holds changed rows
    only) and is refused: merge by key in ``run_foreach_batch``.  ``shards``
    (T11) asks for a number of files per micro-batch; without it the stream
    keeps its own partitions.  ``progress``, when given, receives each
    micro-batch's progress report (with the metrics of any ``tap``).  Returns
    the output path.
    """
    if output_mode not in ("append", "complete"):
        raise ValueError(f"output mode {output_mode!r} has no file form")
    spark = stream.sparkSession
    output = output or scratch_path(spark, f"{name}_out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}_ckpt")
    if shards:
        stream = stream.repartition(shards)
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if output_mode == "append":
        q = (writer.format(fmt).outputMode("append")
             .trigger(availableNow=True).start(output))
    else:
        def overwrite(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(output)
        q = (writer.foreachBatch(overwrite).outputMode(output_mode)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if progress is not None:
        progress.extend(q.recentProgress)
    return output


#: Event time of the message that closes a stream: later than any real event.
CLOSING_TIME = "9000-01-01 00:00:00"


def run_to_end(stream: DataFrame, ts: str, name: str, build: Callable[[DataFrame], DataFrame],
               checkpoint: str | None = None, output: str | None = None) -> str:
    """T2-T5 over a stream that ends: every window closes, the last ones too.

    ``build`` turns the events into the windowed result (append mode, bounded
    state).  One run takes all events; when it has, a closing message, a row
    with only ``ts`` set to ``CLOSING_TIME``, moves the watermark past every
    open window and the same run emits them and stops.  Rows of the closing
    message's own windows are the caller's to drop (see ``before_closing``).
    A run that fails goes on from its checkpoint.  Returns the output path.
    """
    spark = stream.sparkSession
    output = output or scratch_path(spark, f"{name}_out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}_ckpt")
    closing = scratch_path(spark, f"{name}_closing")
    row = spark.range(1).select(*[
        (F.to_timestamp_ntz(F.lit(CLOSING_TIME)) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in stream.schema])
    row.limit(0).write.parquet(closing)
    both = build(stream.unionByName(spark.readStream.schema(stream.schema).parquet(closing)))
    query = (both.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(processingTime="0 seconds").start(output))
    try:
        query.processAllAvailable()
        row.write.mode("append").parquet(closing)
        query.processAllAvailable()  # the message, and the batch that its watermark closes the windows in
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return output


def before_closing(ts) -> Column:
    """Rows that do not belong to the closing message (a day of slack for
    windows that reach back from it)."""
    return F.col(ts) < F.timestamp_add("DAY", F.lit(-1), F.to_timestamp_ntz(F.lit(CLOSING_TIME)))


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """The data files of a folder: (path); contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path")


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The files that a stream's source has taken in committed batches, from
    its own log in the checkpoint: (path), as the log spells them."""
    log = spark.read.text(f"{checkpoint.rstrip('/')}/sources/0").where(F.col("value").startswith("{"))
    return log.select(F.get_json_object("value", "$.path").alias("path")).distinct()


def delete_files(spark: SparkSession, paths: DataFrame) -> None:
    """Remove files (URIs in column ``path``) on whatever file system they are;
    the list streams by, a partition at a time.  Missing ones are skipped."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    for row in paths.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.path))
        p.getFileSystem(hadoop).delete(p, False)


def ingest_and_remove(spark: SparkSession, landing: str, schema, name: str, fmt: str = "parquet",
                      output: str | None = None, checkpoint: str | None = None) -> str:
    """Append everything in the landing folder, then remove the files that
    the stream has taken.  They go only after the run has committed; after a
    failure in between, the checkpoint keeps the next run from taking them
    twice, and it removes them.  Files that arrive meanwhile stay."""
    checkpoint = checkpoint or scratch_path(spark, f"{name}_ckpt")
    output = run_to_files(file_stream(spark, landing, schema, fmt), name, output=output, checkpoint=checkpoint)
    delete_files(spark, taken_files(spark, checkpoint))
    return output


def run_for_seconds(stream: DataFrame, name: str, seconds: float,
                    output: str | None = None, checkpoint: str | None = None,
                    trigger: str = "1 second", fmt: str = "parquet") -> str:
    """S14 bounded listen on an unbounded source: run micro-batches for
    ``seconds``, then stop cleanly (committed batches stay; a restart with the
    same checkpoint resumes after them).  Returns the output path."""
    spark = stream.sparkSession
    output = output or scratch_path(spark, f"{name}_out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}_ckpt")
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .trigger(processingTime=trigger).start(output))
    q.awaitTermination(seconds)
    q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return output


def run_foreach_batch(stream: DataFrame, name: str,
                      handler: Callable[[DataFrame, int], None],
                      checkpoint: str | None = None) -> None:
    """Run ``handler(batch, batch_id)`` over everything available now.
    The handler must be idempotent per ``batch_id`` (a retried batch re-runs)."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"{name}_ckpt")
    q = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(handler).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def valid_rejects_sink(valid_path: str, rejects_path: str, col: str, schema: str,
                       project: Callable[[DataFrame], DataFrame]):
    """A ``foreachBatch`` handler that parses ``col`` as JSON, appends the
    projected valid rows to one table and the rejects to another.  The batch
    is persisted once so the split does not read the source twice; rows carry
    the batch id so a retried batch replaces its own output."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        ok = is_json_object(col)
        batch.persist()
        try:
            tagged = batch.withColumn("batch_id", F.lit(batch_id))
            (project(tagged.filter(ok).withColumn("parsed", F.from_json(F.col(col), schema)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(valid_path))
            (tagged.filter(~ok | F.col(col).isNull())
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(rejects_path))
        finally:
            batch.unpersist()
    return handle
