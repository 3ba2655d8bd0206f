"""Streaming twins.

Each query runs a real Structured Streaming job over the events table as a
file stream (``availableNow``: everything present, then a clean stop), with
checkpoints in the shared folder, and returns the sink's contents as a batch
DataFrame.  Windowed aggregates use append mode with a watermark, the form
whose state stays bounded; a closing message at the end of the stream
(``streams.run_to_end``) closes the last windows, so every query equals its
batch twin over all events.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import windows as WN
from ..operators.windows import sessions_from_buckets
from ..session import parallelism, scratch_path, table_path
from ..sinks import writers as W
from ..sources import messages as MS
from ..streaming import panes as PN
from ..streaming import sessions as SS
from ..streaming import streams as ST
from .registry import query, table

# Allowed lateness and windows of the streaming jobs.
LATENESS = "1 minute"
STREAM_FIXED = "5 seconds"
SESSION_GAP_S = 30 * 60


def events_stream(spark, sf_dir, **kw):
    """The events table as a file stream (a glob: streams take a directory
    or pattern, not one file)."""
    schema = table(spark, sf_dir, "events").schema
    return ST.file_stream(spark, table_path(sf_dir, "events") + "*", schema, **kw)


@query("stream_available_now", ids=("S13", "S14", "T9", "K11"), sql="""
select event_id, user_id, event_type from events
""")
def stream_available_now(spark, sf_dir):
    """Consume everything available, then stop.  A tap reports the row count
    and the newest event id of every micro-batch as named metrics."""
    s = events_stream(spark, sf_dir).select("event_id", "user_id", "event_type")
    tapped = W.tap(s, "events_tap", rows=F.count(F.lit(1)), newest=F.max("event_id"))
    return spark.read.parquet(ST.run_to_files(tapped, "available_now"))


@query("stream_file_ingest", ids=("S15",), sql="""
select event_id, user_id, event_type, value from events
""")
def stream_file_ingest(spark, sf_dir):
    """Files arrive in a landing folder; each is appended once and leaves the
    folder when the run has committed."""
    landing = scratch_path(spark, "landing")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    ev.write.mode("overwrite").parquet(landing)
    return spark.read.parquet(ST.ingest_and_remove(spark, landing, ev.schema, "file_ingest"))


def _json_messages(spark, sf_dir):
    """events as JSON messages ``{"timestamp": ..., "data": ...}``; the
    ``error`` events' messages lose their closing brace (malformed)."""
    ev = table(spark, sf_dir, "events")
    msg = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("props").alias("data")))
    damaged = F.when(F.col("event_type") == "error",
                     F.expr("substring(msg, 1, length(msg) - 1)")).otherwise(F.col("msg"))
    return (ev.select("event_id", "event_type", msg.alias("msg"))
              .select("event_id", damaged.alias("value")))


@query("stream_message_log", ids=("S13", "S14", "S17"), sql="""
select event_id, user_id, event_type, value, row_number() over (order by event_id) - 1 as offset from events
""")
def stream_message_log(spark, sf_dir):
    """The events as a message log: published in two batches, consumed a seventh
    at a time by two runs of the stream, the second from the first's checkpoint."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    log, out, ckpt = (scratch_path(spark, f"log_{x}") for x in ("messages", "out", "ckpt"))
    half = ev.select(F.expr("percentile_approx(event_id, 0.5)")).scalar()
    MS.publish(ev.where(F.col("event_id") <= half), log, ["event_id"])
    step = -(-2 * MS.end_offset(log) // 7)
    MS.listen(MS.stream(spark, log, ev.schema, ckpt, step, step // 2), "log", ckpt, out, until=step)
    MS.publish(ev.where(F.col("event_id") > half), log, ["event_id"])
    messages = MS.stream(spark, log, ev.schema, ckpt, step, step // 2)
    return spark.read.parquet(MS.listen(messages, "log", ckpt, out, until=MS.end_offset(log)))


@query("stream_json_parse", ids=("T8", "P6", "R16", "K1"), sql="""
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as timestamp, props as data
from events where event_type <> 'error'
""")
def stream_json_parse(spark, sf_dir):
    topic = scratch_path(spark, "json_topic")
    _json_messages(spark, sf_dir).write.mode("overwrite").parquet(topic)
    schema = "event_id BIGINT, value STRING"
    s = ST.file_stream(spark, topic, schema)
    valid, rejects = scratch_path(spark, "json_valid"), scratch_path(spark, "json_rejects")

    def project(df):
        return W.conform(df.select("event_id", "batch_id", F.col("parsed.timestamp").alias("timestamp"),
                                   F.col("parsed.data").alias("data")),
                         "event_id:INT64,timestamp:STRING,data:STRING,batch_id:INT64")

    ST.run_foreach_batch(s, "json_parse",
                         ST.valid_rejects_sink(valid, rejects, "value",
                                               "timestamp STRING, data STRING", project))
    return spark.read.parquet(valid).select("event_id", "timestamp", "data")


@query("stream_append_sink", ids=("T9", "T11", "K1"), sql="""
select event_id, user_id, event_type, value from events
""")
def stream_append_sink(spark, sf_dir):
    s = W.conform(events_stream(spark, sf_dir),
                  "event_id:INT64,user_id:INT64,event_type:STRING,value:FLOAT64")
    # The shard count is an argument (T11); here: as many as there are task slots.
    return spark.read.parquet(ST.run_to_files(s, "append_sink", shards=parallelism(spark)))


def _num_messages(spark, sf_dir):
    """The test feed's ``"<num>,<yyyy-MM-dd HH:mm:ss.ffffff>"`` UTF-8 messages."""
    ev = table(spark, sf_dir, "events")
    text = F.concat_ws(",", F.col("event_id").cast("string"),
                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return ev.select(F.encode(text, "UTF-8").alias("value"))


def _parsed_messages(spark, sf_dir):
    topic = scratch_path(spark, "num_topic")
    _num_messages(spark, sf_dir).write.mode("overwrite").parquet(topic)
    s = ST.decode_utf8(ST.file_stream(spark, topic, "value BINARY"))
    parts = F.split("text", ",", 2)
    parsed = s.select(parts[0].try_cast("bigint").alias("num"),
                      F.to_timestamp_ntz(parts[1]).alias("ts"))
    return parsed.filter(F.col("ts").isNotNull())


def _windows(spark, path):
    """The stored windows without the closing message's."""
    out = spark.read.parquet(path)
    return (out.select(T.ltz_to_ntz("window_start").alias("window_start"),
                       T.ltz_to_ntz("window_end").alias("window_end"), "n")
               .filter(ST.before_closing("window_start")))


@query("stream_fixed_count", ids=("T1", "T2", "T7", "T10", "R15", "R21", "S13"), headline=True, sql="""
select time_bucket(interval 5 seconds, ts) as window_start,
       time_bucket(interval 5 seconds, ts) + interval 5 seconds as window_end, count(*) as n
from events group by 1, 2
""")
def stream_fixed_count(spark, sf_dir):
    def counts(s):
        return WN.fixed_windows(ST.with_event_time(s, "ts", LATENESS), "event_time", STREAM_FIXED)
    return _windows(spark, ST.run_to_end(_parsed_messages(spark, sf_dir), "ts", "fixed_count", counts))


@query("stream_late_rows", ids=("T10",), sql="""
with first as (select ts from events where event_type <> 'error'),
mark as (select max(ts) - interval 1 minute as w from first),
taken as (select ts from first union all
          select ts from events, mark where event_type = 'error'
            and time_bucket(interval 5 seconds, ts) + interval 5 seconds > w)
select time_bucket(interval 5 seconds, ts) as window_start,
       time_bucket(interval 5 seconds, ts) + interval 5 seconds as window_end, count(*) as n
from taken group by 1, 2
""")
def stream_late_rows(spark, sf_dir):
    """The ``error`` events arrive after all others: those whose window the
    watermark has closed are dropped, the rest still count."""
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    landing, out, ckpt = (scratch_path(spark, f"late_{x}") for x in ("in", "out", "ckpt"))
    events.filter("event_type <> 'error'").write.parquet(landing)
    s = ST.file_stream(spark, landing, events.schema)
    counts = WN.fixed_windows(ST.with_event_time(s, "ts", LATENESS), "event_time", STREAM_FIXED)
    ST.run_to_files(counts, "late", checkpoint=ckpt, output=out)
    events.filter("event_type = 'error'").write.mode("append").parquet(landing)
    ST.run_to_files(counts, "late", checkpoint=ckpt, output=out)
    end = events.select(F.to_timestamp_ntz(F.lit(ST.CLOSING_TIME)).alias("ts"), F.lit("end").alias("event_type")).limit(1)
    end.write.mode("append").parquet(landing)
    return _windows(spark, ST.run_to_files(counts, "late", checkpoint=ckpt, output=out))


#: Windows of ``stream_late_panes``, and for how long late rows still count.
PANE_SECONDS, PANE_LATENESS_S = 3600, 60 * 86400


@query("stream_late_panes", ids=("T9", "T10", "T2"), sql="""
select time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
       count(*) as n,
       count(*) filter (event_type = 'error' and time_bucket(interval 1 hour, ts) + interval 1 hour <= w) as n_late
from events, (select max(ts) as w from events where event_type <> 'error') group by 1, 2
""")
def stream_late_panes(spark, sf_dir):
    """Hourly counts in panes: the ``error`` events arrive after all others,
    when the watermark has closed all windows but the last; a late pane corrects
    the count.  The last pane is the batch count, its excess over the panes in
    time the late rows."""
    events = table(spark, sf_dir, "events").select("ts", "event_type")
    landing, out, ckpt = (scratch_path(spark, f"panes_{x}") for x in ("in", "out", "ckpt"))
    events.filter("event_type <> 'error'").write.parquet(landing)
    panes = PN.window_panes(ST.file_stream(spark, landing, events.schema), "ts", PANE_SECONDS, PANE_LATENESS_S)
    PN.run(panes, "panes", checkpoint=ckpt, output=out)
    events.filter("event_type = 'error'").write.mode("append").parquet(landing)
    PN.run(panes, "panes", checkpoint=ckpt, output=out)
    stored = spark.read.parquet(out)
    kept = stored.groupBy("window_us").agg(F.max_by("n", "pane").alias("n"),
                                           F.max(F.when(F.col("timing") != "late", F.col("n"))).alias("in_time"))
    start = F.timestamp_add("MICROSECOND", F.col("window_us"), F.expr(T.EPOCH_NTZ))
    return kept.select(start.alias("window_start"), F.timestamp_add("SECOND", F.lit(PANE_SECONDS), start).alias("window_end"),
                       "n", (F.col("n") - F.coalesce("in_time", F.lit(0))).alias("n_late"))


@query("stream_window_label", ids=("T2", "T6", "T9", "R18", "R15", "R21"), sql="""
select format('{}  [{} - {}]', count(*),
              strftime(time_bucket(interval 5 seconds, ts), '%Y-%m-%d %H:%M:%S'),
              strftime(time_bucket(interval 5 seconds, ts) + interval 5 seconds, '%Y-%m-%d %H:%M:%S'))
       as count_window
from events group by time_bucket(interval 5 seconds, ts)
""")
def stream_window_label(spark, sf_dir):
    """The streaming window-count job end to end (``jobs.window_counts_stream``):
    messages -> event time -> 5 s windows -> ``"<n>  [start - end]"`` rows."""
    from ..jobs import window_counts_stream
    topic = scratch_path(spark, "label_topic")
    _num_messages(spark, sf_dir).write.mode("overwrite").parquet(topic)
    return window_counts_stream(spark, topic, scratch_path(spark, "label_out"),
                                scratch_path(spark, "label_ckpt"), window=STREAM_FIXED,
                                lateness=LATENESS, to_end=True)


@query("stream_sliding_count", ids=("T1", "T3", "T10"), sql="""
with a as (select time_bucket(interval 150 seconds, ts) as s from events
           union all
           select time_bucket(interval 150 seconds, ts) - interval 150 seconds from events)
select s as window_start, s + interval 300 seconds as window_end, count(*) as n
from a group by s
""")
def stream_sliding_count(spark, sf_dir):
    def counts(s):
        return WN.sliding_windows(ST.with_event_time(s, "ts", LATENESS), "event_time", "300 seconds", "150 seconds")
    return _windows(spark, ST.run_to_end(events_stream(spark, sf_dir), "ts", "sliding_count", counts))


def _session_sql(key: str = "") -> str:
    """Sessions straight from the events."""
    sel, part = (f"{key},", f"partition by {key}") if key else ("", "")
    return f"""
with e as (select {sel} ts, lag(ts) over ({part} order by ts) as prev from events),
s as (select *, sum(case when prev is null or ts - prev > interval 30 minutes then 1 else 0 end)
             over ({part} order by ts rows unbounded preceding) as sid from e)
select {sel} min(ts) as session_start, max(ts) + interval 30 minutes as session_end, count(*) as n
from s group by {sel} sid
"""


def _two_stage_sessions(spark, sf_dir, keys, name):
    def buckets(s):
        return SS.bucket_stream(ST.with_event_time(s, "ts", LATENESS), "event_time", SESSION_GAP_S, keys)
    stored = spark.read.parquet(ST.run_to_end(events_stream(spark, sf_dir), "ts", name, buckets))
    epoch = F.expr(T.EPOCH_NTZ)
    stored = (stored.withColumn("__at", F.timestamp_add("MICROSECOND", F.col("__lo"), epoch))
                    .filter(ST.before_closing("__at")).drop("__at"))
    sess = sessions_from_buckets(stored, SESSION_GAP_S, keys)
    return sess.select(*keys,
                       F.timestamp_add("MICROSECOND", F.col("start_us"), epoch).alias("session_start"),
                       F.timestamp_add("MICROSECOND", F.col("end_us"), epoch).alias("session_end"),
                       "n")


@query("stream_session_user", ids=("T5", "T10"), headline=True, sql=_session_sql("user_id"))
def stream_session_user(spark, sf_dir):
    """Per-user sessions from a stream in two stages: (user, bucket) state in
    the stream, final sessions stitched from the bucket table.  A hot user
    spreads over its buckets instead of one state key."""
    return _two_stage_sessions(spark, sf_dir, ["user_id"], "session_user_buckets")


@query("stream_session_global", ids=("T4", "T10"), sql=_session_sql())
def stream_session_global(spark, sf_dir):
    """One global session line from a stream, without one hot state key."""
    return _two_stage_sessions(spark, sf_dir, [], "session_buckets")


@query("stream_session_user_native", ids=("T5", "T10"), sql=_session_sql("user_id"))
def stream_session_user_native(spark, sf_dir):
    """Per-user sessions with Spark's streaming ``session_window`` (state keyed
    by user; a session is emitted once the watermark passes its end).  The
    idiomatic form, kept for comparison: every event of a hot user goes
    through one state key, so ``stream_session_user`` (two stages, state per
    (user, bucket)) is the form to use at scale."""
    def sessions(s):
        grouped = ST.with_event_time(s, "ts", LATENESS).groupBy(
            "user_id", F.session_window("event_time", "30 minutes").alias("w"))
        return grouped.agg(F.count(F.lit(1)).alias("n")).select(
            "user_id", F.col("w.start").alias("s"), F.col("w.end").alias("e"), "n")
    out = spark.read.parquet(ST.run_to_end(events_stream(spark, sf_dir), "ts", "session_user", sessions))
    return out.select("user_id", T.ltz_to_ntz("s").alias("session_start"),
                      T.ltz_to_ntz("e").alias("session_end"), "n").filter(ST.before_closing("session_start"))
