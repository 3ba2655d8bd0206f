"""Job-level entry points: each function reproduces one of the reference's ETL
jobs as a Spark job over paths a user provides, composed from the library's
operators.  Every function returns the result DataFrame (read back from what
it wrote, where it writes).

| job | reference job it replaces |
| --- | --- |
| ``department_first_join`` | batch CSV -> count + first joiner per department -> JSON lines |
| ``trading_net_quantity`` | CSV -> SQL (signed quantities summed per symbol) -> append table |
| ``selected_word_counts`` | text -> words -> selected words -> count per word |
| ``player_totals`` | JSON array file -> flatten -> filter -> SQL totals per player |
| ``window_counts_stream`` | "num,timestamp" messages -> fixed windows -> labelled counts |
| ``json_messages_stream`` | JSON messages -> parse or reject -> (timestamp, data) table |
| ``country_counts`` | CSV with a DDL schema -> count per destination -> CSV append |
| ``emissions_summary`` | header CSV -> rename -> sum + distinct count -> save |
| ``clean_csv_ingest`` | dirty ``;`` CSV files as they arrive -> cleaned, typed, stamped rows |
| ``news_lines`` | text block -> lines -> drop channel names, "N hours ago", blanks |
| ``distinct_top_rentals`` | SQL: distinct rows of one day, ordered, first 100 |
| ``load_then_summarize`` | CSV autodetect truncate-load -> CREATE OR REPLACE ... AS SELECT |
| ``sql_to_table`` | SQL text -> result table |
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import aggregates as A
from .operators import clean as K
from .operators import cogroup as C
from .operators import filters as FL
from .operators import sets as S
from .operators import transforms as X
from .operators import windows as WN
from .sinks import writers as W
from .sources import files as SRC
from .streaming import streams as ST

# The employee file's external header list.
EMPLOYEE_FIELDS = ["emp_id", "name", "depart", "join_date"]
# The trading file's fields by position and the sink schema.
TRADING_FIELDS = ["Symbol", "BuyOrSell", "QuantityTraded"]
TRADING_SINK = "Symbol:STRING,QuantityTraded:INT64"
# Sink schema of the message table.
MESSAGE_SINK = "timestamp:STRING,data:STRING"
# The flight file's DDL schema.
FLIGHTS_DDL = "DEST_COUNTRY_NAME STRING, ORIGIN_COUNTRY_NAME STRING, count INT"


def department_first_join(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """Per department: head count and the first employee to join (lowest id on
    a tie; an unparseable date sorts last and is written as null), as JSON."""
    emp = SRC.read_csv_positional(spark, csv_path, EMPLOYEE_FIELDS)
    emp = emp.withColumn("jd", T.parse_date("join_date"))
    agg = C.named_aggregates(emp, "depart", emp_count_depart=F.count(F.lit(1)),
                             first=A.first_by(["jd", F.col("emp_id").try_cast("bigint"),
                                               "emp_id"], ["emp_id"]))
    out = agg.select("depart", "emp_count_depart",
                     F.coalesce(F.col("first.emp_id"), F.lit("")).alias("emp_id"),
                     T.iso_datetime(F.col("first.__o0").cast("timestamp_ntz")).alias("join_date"))
    W.write_json_lines(out, out_path)
    return SRC.read_json_lines(spark, out_path, "depart STRING, emp_count_depart BIGINT, "
                                                "emp_id STRING, join_date STRING")


#: Net quantity per symbol: buys count positive, all others negative; thousands
#: commas are dropped, text that is no number counts as NULL.
NET_QUANTITY_SQL = """
    select Symbol,
           sum(if(BuyOrSell = 'Buy', 1, -1) * try_cast(replace(QuantityTraded, ',', '') as bigint)) as QuantityTraded
    from {trades} group by Symbol
"""


def trading_net_quantity(spark: SparkSession, csv_path: str, table_path: str) -> DataFrame:
    """Buy quantities count positive, others negative (thousands commas removed
    on both sides); the net per symbol is appended to a declared-schema table."""
    rows = SRC.read_csv_positional(spark, csv_path, TRADING_FIELDS)
    net = SRC.sql_source(spark, NET_QUANTITY_SQL, trades=rows)
    W.append_declared(net, table_path, TRADING_SINK)
    return spark.read.parquet(table_path)


def selected_word_counts(spark: SparkSession, text_path: str,
                         words: Sequence[str] | None = None) -> DataFrame:
    """Words (split on single spaces) of a text file, optionally only the
    listed ones, counted per word."""
    w = X.tokens(SRC.read_text_lines(spark, text_path), "value", " ", with_position=False)
    if words is not None:
        w = w.filter(FL.in_literals("word", words))
    return A.count_per_element(w.select("word"))


def player_totals(spark: SparkSession, json_path: str, table_path: str | None = None,
                  schema: str | None = None) -> DataFrame:
    """Players' matches from a JSON-array file, matches without overs dropped,
    then per player: best previous-3 average list, total runs and wickets."""
    players = SRC.read_json_array(spark, json_path, schema)
    m = players.select("player_name", "previous_3_batting_avg",
                       F.explode("performance").alias("m"))
    m = m.filter(FL.not_equal("m.bowling.overs", 0))
    prev = F.from_json(F.col("previous_3_batting_avg").cast("string"), "array<double>")
    out = (m.groupBy(F.col("player_name").alias("playername"))
           .agg(F.max(prev).alias("best_previous3innings"),
                F.sum("m.batting.runs").alias("total_run"),
                F.sum("m.bowling.wickets").alias("total_wickets")))
    if table_path:
        W.append_autodetect(spark, out, table_path)
        return spark.read.parquet(table_path)
    return out


def window_counts_stream(spark: SparkSession, source_dir: str, out_path: str,
                         checkpoint: str, window: str = "5 seconds",
                         lateness: str = "1 minute", shards: int | None = None,
                         to_end: bool = False) -> DataFrame:
    """Messages ``"<num>,<timestamp>"`` (UTF-8 ``value``) streamed from files:
    event time from the message, fixed windows, one labelled count per closed
    window (append mode; rows later than ``lateness`` are dropped).  With
    ``to_end`` the stream ends here and its last windows close too."""
    s = ST.decode_utf8(ST.file_stream(spark, source_dir, "value BINARY"))
    parts = F.split("text", ",", 2)
    parsed = s.select(F.to_timestamp_ntz(parts[1]).alias("ts")).filter(F.col("ts").isNotNull())

    def labelled(events):
        counts = WN.fixed_windows(ST.with_event_time(events, "ts", lateness), "event_time", window)
        start, end = T.ltz_to_ntz("window_start"), T.ltz_to_ntz("window_end")
        return counts.withColumn("__at", start).filter(ST.before_closing("__at")).select(
            T.window_label("n", start, end).alias("count_window"))

    if to_end:
        ST.run_to_end(parsed, "ts", "window_counts", labelled, checkpoint=checkpoint, output=out_path)
    else:
        ST.run_to_files(labelled(parsed), "window_counts", output=out_path, checkpoint=checkpoint,
                        shards=shards)
    return spark.read.parquet(out_path)


def json_messages_stream(spark: SparkSession, source_dir: str, out_path: str,
                         rejects_path: str, checkpoint: str) -> DataFrame:
    """JSON messages (``value`` text) streamed from files: parsed ones are
    appended as (timestamp, data) strings, malformed ones kept apart."""
    s = ST.file_stream(spark, source_dir, "value STRING")

    def project(df):
        return W.conform(df.select(F.col("parsed.timestamp").alias("timestamp"),
                                   F.col("parsed.data").alias("data"), "batch_id"),
                         MESSAGE_SINK + ",batch_id:INT64")

    ST.run_foreach_batch(s, "json_messages", ST.valid_rejects_sink(
        out_path, rejects_path, "value", "timestamp STRING, data STRING", project),
        checkpoint=checkpoint)
    return spark.read.parquet(out_path).select("timestamp", "data")


def country_counts(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """Flights per destination country (non-null origins counted), appended
    as CSV."""
    flights = SRC.read_csv_typed(spark, csv_path, FLIGHTS_DDL)
    out = A.count_non_null(flights, "DEST_COUNTRY_NAME", "ORIGIN_COUNTRY_NAME", out="count")
    W.append_csv(out, out_path)
    return out


def emissions_summary(spark: SparkSession, csv_path: str, out_path: str,
                      approximate: bool = False) -> DataFrame:
    """Per (Year, Country): total emissions and number of distinct gases; the
    result is saved with Spark's default mode (fails if the target exists)."""
    raw = SRC.read_csv_untyped(spark, csv_path)
    named = X.rename_column(raw, "Emissions (metric tons CO2e)", "emission_in_ton")
    named = named.withColumn("emission_in_ton", F.col("emission_in_ton").try_cast("double"))
    out = A.sum_and_distinct(named, ["Year", "Country"], "emission_in_ton", "Gas",
                             sum_out="total_emission", distinct_out="gas_count",
                             approximate=approximate)
    W.save_default_mode(out, out_path)
    return spark.read.parquet(out_path)


def _conform_to_table(batch: DataFrame, existing: dict[str, str]) -> DataFrame:
    """Cast a cleaned batch to the types the table already has where that
    loses nothing (bigint -> double, number -> string); a column that would
    have to narrow (double -> bigint, string -> number) fails loudly."""
    out = []
    for name, typ in batch.dtypes:
        old = existing.get(name)
        if old is None or old == typ:
            out.append(F.col(f"`{name}`"))
        elif (old, typ) in {("double", "bigint"), ("string", "bigint"), ("string", "double")}:
            out.append(F.col(f"`{name}`").cast(old).alias(name))
        else:
            raise TypeError(f"column {name!r} was {old} in earlier files and is {typ} now; "
                            "ingest with numeric_as_double=True for stable types")
    return batch.select(*out)


def clean_csv_ingest(spark: SparkSession, landing_dir: str, out_path: str,
                     checkpoint: str, sep: str = ";",
                     numeric_as_double: bool = False, remove_source: bool = False,
                     processed_at: Column | None = None) -> DataFrame:
    """Every dirty CSV file that lands (``;`` separated, decimal commas, empty
    header cells, odd names) is cleaned once and appended: names sanitised,
    unnamed columns dropped, numeric columns typed, a processing time added.

    Types are decided from each micro-batch's content; later batches are cast
    to the table's types where that is lossless.  ``numeric_as_double`` types
    every numeric column as double, which never conflicts.  ``remove_source``
    takes the files that the run has taken in out of the landing folder once
    it has committed; ``processed_at`` replaces the clock."""
    # A file stream needs a schema: take it from the header of the files present.
    files = spark.read.option("header", True).option("sep", sep).csv(landing_dir)
    stream = (spark.readStream.schema(files.schema).option("header", True)
              .option("sep", sep).csv(landing_dir))

    def handle(batch: DataFrame, batch_id: int) -> None:
        cleaned = K.numeric_columns(K.sanitize_column_names(K.drop_unnamed(batch)))
        if numeric_as_double:
            cleaned = cleaned.select(*[F.col(f"`{n}`").cast("double").alias(n) if t == "bigint"
                                       else F.col(f"`{n}`") for n, t in cleaned.dtypes])
        existing = {n: t.simpleString() for n, t in W.target_types(spark, out_path).items()}
        cleaned = _conform_to_table(cleaned, existing)
        K.with_processed_at(cleaned, at=processed_at).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id").parquet(out_path)

    ST.run_foreach_batch(stream, "clean_ingest", handle, checkpoint=checkpoint)
    if remove_source:
        ST.delete_files(spark, ST.taken_files(spark, checkpoint))
    return spark.read.parquet(out_path)


def news_lines(df: DataFrame, col: str, channels: Sequence[str],
               hours_pattern: str = r"^[0-9]+ (hours|hour) ago$") -> DataFrame:
    """Lines of each text block, stripped; channel names, "N hours ago" lines
    and blank lines removed; line order kept in ``pos``."""
    lines = X.tokens(df, col, "\n", out="line").withColumn("line", T.strip_ws("line"))
    return (lines.filter(~FL.in_literals("line", channels))
                 .filter(FL.regex_not_match("line", hours_pattern))
                 .filter(FL.non_empty_after_strip("line")))


def distinct_top_rentals(spark: SparkSession, rentals: DataFrame, day: str,
                         id_col: str = "rental_id", ts_col: str = "start_date",
                         limit: int = 100) -> DataFrame:
    """Distinct (id, start) pairs of one day, earliest first, first ``limit``."""
    return SRC.sql_source(spark, f"""
        select distinct `{id_col}`, `{ts_col}` from {{rentals}}
        where to_date(`{ts_col}`) = to_date(:day)
        order by `{ts_col}`, `{id_col}` limit {int(limit)}""", {"day": day}, rentals=rentals)


def load_then_summarize(spark: SparkSession, csv_path: str, stage_path: str,
                        table_name: str, table_path: str,
                        keys: Sequence[str] = ("Symbol", "BuyOrSell"),
                        value: str = "QuantityTraded") -> DataFrame:
    """Load a CSV with inferred types, replacing the staging data, then
    replace a summary table with the per-key sums."""
    W.overwrite(SRC.read_csv_inferred(spark, csv_path), stage_path)
    staged = spark.read.parquet(stage_path)
    summary = staged.groupBy(*keys).agg(F.sum(value).alias("total_count"))
    summary.write.mode("overwrite").option("path", table_path).saveAsTable(table_name)
    return spark.table(table_name)


def sql_to_table(spark: SparkSession, sql: str, table_name: str, table_path: str,
                 **views: DataFrame) -> DataFrame:
    """Run SQL over the given frames (``{name}`` in the text) and replace a
    table with the result."""
    result = SRC.sql_source(spark, sql, **views)
    result.write.mode("overwrite").option("path", table_path).saveAsTable(table_name)
    return spark.table(table_name)


def symmetric_sets(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """The four set results of two single-column frames."""
    return {"intersection": S.intersect(a, b), "union": S.union_distinct(a, b),
            "b_minus_a": S.difference(b, a), "symmetric": S.symmetric_difference(a, b)}
