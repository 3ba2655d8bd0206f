"""Batch event-time window queries over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import windows as WN
from .registry import query, table

# Window parameters of the reference jobs.
FIXED = "5 minutes"
SLIDE_SIZE, SLIDE_STEP = "300 seconds", "150 seconds"
SESSION_GAP_S = 30 * 60


@query("window_fixed_count", ids=("T2", "T7"), headline=True, sql="""
select time_bucket(interval 5 minutes, ts) as window_start,
       time_bucket(interval 5 minutes, ts) + interval 5 minutes as window_end,
       count(*) as n
from events group by 1, 2
""")
def window_fixed_count(spark, sf_dir):
    return WN.fixed_windows(table(spark, sf_dir, "events"), "ts", FIXED)


@query("window_sliding_count", ids=("T3",), sql="""
with a as (select time_bucket(interval 150 seconds, ts) as s from events
           union all
           select time_bucket(interval 150 seconds, ts) - interval 150 seconds from events)
select s as window_start, s + interval 300 seconds as window_end, count(*) as n
from a group by s
""")
def window_sliding_count(spark, sf_dir):
    return WN.sliding_windows(table(spark, sf_dir, "events"), "ts", SLIDE_SIZE, SLIDE_STEP)


@query("window_sliding_panes", ids=("T3",), sql="""
with m as (select time_bucket(interval 1 minute, ts) as p, count(*) as n, max(value) as v from events group by 1),
     w as (select p - to_minutes(cast(i as integer)) as s, n, v from m, range(60) r(i))
select s as window_start, s + interval 1 hour as window_end, cast(sum(n) as bigint) as n, max(v) as highest
from w group by s
""")
def window_sliding_panes(spark, sf_dir):
    """An hour every minute: 60 windows hold each event, but an event is
    aggregated once, into its pane."""
    return WN.sliding_by_panes(table(spark, sf_dir, "events"), "ts", 3600, 60,
                               aggs={"n": ("count", "1"), "highest": ("max", "value")})


@query("window_sliding_panes_user", ids=("T3",), sql="""
with a as (select event_type, time_bucket(interval 100 seconds, ts) - to_seconds(100 * cast(i as integer)) as s, ts
           from events, range(3) r(i))
select event_type, s as window_start, s + interval 250 seconds as window_end, count(*) as n
from a where ts < s + interval 250 seconds group by 1, 2
""")
def window_sliding_panes_user(spark, sf_dir):
    """250 s every 100 s: panes of 50 s, and windows by key."""
    return WN.sliding_by_panes(table(spark, sf_dir, "events"), "ts", 250, 100, keys=["event_type"])


_SESSIONS_SQL = """
with e as (select {keys_sel} ts, lag(ts) over (partition by {part} order by ts) as prev from events),
s as (select *, sum(case when prev is null or ts - prev > interval 30 minutes then 1 else 0 end)
             over (partition by {part} order by ts rows unbounded preceding) as sid from e)
select {keys_sel} min(ts) as session_start, max(ts) + interval 30 minutes as session_end,
       count(*) as n
from s group by {keys_grp} sid
"""


@query("window_session_global", ids=("T4",), headline=True,
       sql=_SESSIONS_SQL.format(keys_sel="", part="1", keys_grp=""))
def window_session_global(spark, sf_dir):
    """One global session line, computed in two phases (never one task)."""
    return WN.sessions(table(spark, sf_dir, "events"), "ts", SESSION_GAP_S)


@query("window_session_user", ids=("T5",), headline=True,
       sql=_SESSIONS_SQL.format(keys_sel="user_id,", part="user_id", keys_grp="user_id,"))
def window_session_user(spark, sf_dir):
    return WN.sessions(table(spark, sf_dir, "events"), "ts", SESSION_GAP_S, keys=["user_id"])


@query("window_label", ids=("R18", "T6"), sql="""
select format('{}  [{} - {}]', count(*), strftime(time_bucket(interval 5 minutes, ts), '%Y-%m-%d %H:%M:%S'),
              strftime(time_bucket(interval 5 minutes, ts) + interval 5 minutes, '%Y-%m-%d %H:%M:%S')) as label
from events group by time_bucket(interval 5 minutes, ts)
""")
def window_label(spark, sf_dir):
    w = WN.fixed_windows(table(spark, sf_dir, "events"), "ts", FIXED)
    return w.select(T.window_label("n", "window_start", "window_end").alias("label"))


@query("window_fixed_by_type", ids=("T2", "T6"), sql="""
select event_type, time_bucket(interval 5 minutes, ts) as window_start,
       time_bucket(interval 5 minutes, ts) + interval 5 minutes as window_end,
       count(*) as n, cast(sum(cast(value as decimal(18, 2))) as decimal(18, 2)) as total_value
from events group by 1, 2, 3
""")
def window_fixed_by_type(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return WN.fixed_windows(ev, "ts", FIXED, keys=["event_type"],
                            aggs={"n": F.count(F.lit(1)),
                                  "total_value": F.sum(F.col("value").cast("decimal(18,2)"))
                                  .cast("decimal(18,2)")})
