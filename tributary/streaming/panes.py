"""Windows with early, on-time and late panes.

Spark's windowed aggregates emit a window once, when the watermark has passed
it, and drop what comes later.  Here a window emits a *pane* whenever its
trigger fires:

* ``early``    every micro-batch that brings rows before the watermark has
               passed the window's end (optional);
* ``on_time``  once, when it passes;
* ``late``     every micro-batch that brings rows after that, until the allowed
               lateness is over; then the window's state is removed and rows
               that still come are dropped.

Panes are numbered from 0 per window.  An accumulating pane counts all rows so
far, a discarding one those since the pane before; so the last accumulating
pane, or the sum of the discarding ones, is the window's batch result.

State is one small row per open window (``transformWithState``), with two
event-time timers: the end of the window and the end of its lateness.  Rows are
counted per window inside each task before they are shuffled, so a window with
a third of all rows sends one row per Arrow batch to its state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .streams import run_to_files, with_event_time

# The processor runs in Python workers: ship it by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PANES = "window_us long, pane long, timing string, n long, dropped long"
_STATE = "total long, sent long, panes long, closed boolean"


class PaneCounter(StatefulProcessor):
    """The panes of one window (keyed by its start in microseconds)."""

    def __init__(self, size_us: int, lateness_us: int, early: bool, accumulate: bool) -> None:
        self.size, self.lateness, self.early, self.accumulate = size_us, lateness_us, early, accumulate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", _STATE)

    def _ends(self, start: int) -> tuple[int, int]:
        """End of the window and of its lateness, in whole milliseconds."""
        return -(-(start + self.size) // 1000), -(-(start + self.size + self.lateness) // 1000)

    def _fire(self, start: int, timing: str, total: int, sent: int, panes: int) -> dict:
        n = total if self.accumulate else total - sent
        return {"window_us": start, "pane": panes, "timing": timing, "n": n, "dropped": 0}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start, came = int(key[0]), sum(int(r["n"].sum()) for r in rows)
        now = timerValues.getCurrentWatermarkInMs()
        end, last = self._ends(start)
        if now >= last:
            yield pd.DataFrame([{"window_us": start, "pane": -1, "timing": "dropped", "n": 0, "dropped": came}])
            return
        out = []
        if self.state.exists():
            total, sent, panes, closed = self.state.get()
        else:
            total, sent, panes, closed = 0, 0, 0, now >= end
            self.handle.registerTimer(last)
            if not closed:
                self.handle.registerTimer(end)
        if now >= end and not closed:  # rows came before the timer was handled
            out.append(self._fire(start, "on_time", total, sent, panes))
            sent, panes, closed = total, panes + 1, True
        total += came
        if closed or self.early:
            out.append(self._fire(start, "late" if closed else "early", total, sent, panes))
            sent, panes = total, panes + 1
        self.state.update((total, sent, panes, closed))
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = int(key[0])
        if not self.state.exists():
            return
        total, sent, panes, closed = self.state.get()
        if not closed:
            yield pd.DataFrame([self._fire(start, "on_time", total, sent, panes)])
            sent, panes = total, panes + 1
            self.state.update((total, sent, panes, True))
        if expiredTimerInfo.getExpiryTimeInMs() >= self._ends(start)[1]:
            self.state.clear()

    def close(self) -> None:
        pass


def window_panes(stream: DataFrame, ts: str, size_seconds: int, lateness_seconds: int, delay: str = "0 seconds",
                 early: bool = True, accumulate: bool = True) -> DataFrame:
    """The panes of tumbling windows over ``ts``: (window_us, pane, timing, n,
    dropped), in append mode.  ``delay`` holds the watermark back; rows with a
    null ``ts`` are left out.  Rows dropped for lateness come as counts with
    timing ``dropped`` and pane -1."""
    size = size_seconds * 1_000_000

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.to_pandas()["us"].dropna().astype("int64")
            found = (t // size * size).value_counts()
            yield pa.RecordBatch.from_arrays([pa.array(found.index, pa.int64()), pa.array(found.to_numpy(), pa.int64())],
                                             names=["window_us", "n"])

    timed = with_event_time(stream, ts, delay)
    counted = timed.select(F.unix_micros("event_time").alias("us")).mapInArrow(count, "window_us long, n long")
    return counted.groupBy("window_us").transformWithStateInPandas(
        PaneCounter(size, lateness_seconds * 1_000_000, early, accumulate), PANES, "Append", "EventTime")


def last_panes(panes: DataFrame) -> DataFrame:
    """The last accumulating pane of every window: its result so far."""
    return panes.where("pane >= 0").groupBy("window_us").agg(
        F.max_by("n", "pane").alias("n"), F.max_by("timing", "pane").alias("timing"), F.max("pane").alias("pane"))


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(panes: DataFrame, name: str, **options) -> str:
    """``streams.run_to_files`` with the state store that timers need."""
    spark = panes.sparkSession
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return run_to_files(panes, name, **options)
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)
