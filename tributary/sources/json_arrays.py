"""One large JSON array read by many tasks.

Spark's multi-line reader holds a file whole in one task.  Here the file is cut
into the scan's ordinary byte ranges (``spark.sql.files.maxPartitionBytes``) at
closing braces, wherever they stand, also inside strings:

1. What a range does to the reader's state is a small map, found without
   knowing the state it starts in: whether it turns "outside a string" into
   "inside" (an odd number of quotes), and by how much it changes the nesting
   for either start.  An escaped quote is told by the backslashes before it; a
   range begins after a brace, which is never escaped.
2. The maps of a file's ranges, a few numbers for each, are composed in order:
   every range then knows the state it starts in.
3. Each range gives the elements that begin and end in it.  What it holds of an
   element that began earlier or ends later is an edge; the edges, at most two
   a range, are joined by their file in order.

A batch of the scan is looked at as one array of bytes, not brace by brace.

Elements are objects; anything else between them (numbers, strings, null) is
left out.  A file that is cut short loses the element that does not end.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize

# The kernels run in Python workers: ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What may stand before an element: brackets, commas and elements that are no objects.
_LEAD = r'(?s)^(?:[^{}"]|"(?:[^"\\]|\\.)*")+'
_QUOTE, _SLASH = 2, 3
#: Per byte: the nesting that a bracket adds, or that it is a quote or a backslash.
_KIND = np.zeros(256, np.int8)
_KIND[list(b'{["\\]}')] = 1, 1, _QUOTE, _SLASH, -1, -1


def effect(content: str | np.ndarray) -> tuple[int, int, int]:
    """(1 if it enters or leaves a string, change of nesting when it starts
    outside a string, and when it starts inside one) of a text or its bytes."""
    if isinstance(content, str):
        content = np.frombuffer(content.encode(), np.uint8)
    _, odd, adds = _signs(content)
    return int(odd[-1]) if len(odd) else 0, int(adds[odd == 0].sum()), int(adds[odd == 1].sum())


def without_lead(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, _LEAD, "", max_replacements=1)


def compose(states: list[tuple[int, int, int, int]]) -> dict[int, tuple[int, int]]:
    """From (range start, its effect) to the state (inside a string, nesting) at
    which each range of a file starts."""
    inside, depth, at = 0, 0, {}
    for start, odd, outer, inner in sorted(states):
        at[start] = (inside, depth)
        depth += inner if inside else outer
        inside ^= odd
    return at


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array, bool]]:
    """(file, range start, pieces, whether these are the range's last) from the
    scan's rows, batch by batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names, starts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        turns = np.flatnonzero((names[1:] != names[:-1]) | (starts[1:] != starts[:-1])) + 1
        cuts = [0, *turns.tolist(), len(names)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            here = (int(names[a]), int(starts[a]))
            if held:
                yield *held, held[:2] != here
            held = (*here, batch.column(0).slice(a, b - a))
    if held:
        yield *held, True


def _braced(pieces: pa.Array, cut_short: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the pieces, each with the brace behind it (``cut_short``:
    the last one has none), and where each ends."""
    whole = pc.binary_join_element_wise(pieces, "}", "", null_handling="replace")
    _, offsets, content = whole.buffers()
    ends = np.frombuffer(offsets, np.int32)[whole.offset:whole.offset + len(whole) + 1].astype(np.int64)
    ends[-1] -= cut_short
    return np.frombuffer(content, np.uint8)[ends[0]:ends[-1]], ends[1:] - ends[0]


def _signs(content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quotes and brackets that are not escaped: where they stand, whether an
    odd number of quotes stands up to there, and the nesting each adds."""
    kind = _KIND[content]
    at = np.flatnonzero(kind)
    kind = kind[at]
    slash = at[kind == _SLASH]
    if len(slash):
        # a run of backslashes escapes what follows where it is odd; a brace ends a run
        first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
        behind = slash[np.append(first[1:], len(slash)) - 1] + 1
        length = np.diff(np.append(first, len(slash)))
        plain = (kind != _SLASH) & ~np.isin(at, behind[length % 2 == 1], assume_unique=True)
        at, kind = at[plain], kind[plain]
    quote = kind == _QUOTE
    return at, np.cumsum(quote) & 1, np.where(quote, 0, kind)


def read_json_array_ranges(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Each file under ``path`` is one JSON array of objects; one row per
    element, read by as many tasks as the files have byte ranges."""
    # a file is known by a hash of its path: a long in each of its very many rows
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), "_metadata.file_block_start")

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[int]] = {}
        for name, start, own, _ in _segments(batches):
            total = found.setdefault((name, start), [0, 0, 0])
            odd, outer, inner = effect(_braced(own, False)[0])
            if total[0]:
                outer, inner = inner, outer
            total[:] = total[0] ^ odd, total[1] + outer, total[2] + inner
        rows = [(*k, *v) for k, v in found.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["file", "start", "odd", "outer", "inner"])

    files: dict[int, list] = {}
    # a few numbers per byte range, as the driver holds for the scan itself
    for r in pieces.mapInArrow(summarize, "file long, start long, odd long, outer long, inner long").collect():
        files.setdefault(r.file, []).append((r.start, r.odd, r.outer, r.inner))
    begins = {name: compose(states) for name, states in files.items()}
    last = {name: max(at) for name, at in begins.items()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        inside = depth = first = 0

        def edge(ended: bool) -> pa.RecordBatch:
            return _rows(*at, 0 if first else 1, ended, pa.array([b"".join(held)]).cast(pa.string()))

        for name, start, own, ends_range in _segments(batches):
            if at != (name, start):
                at, held = (name, start), []
                inside, depth = begins[name][start]
                # a range that starts between two elements has no element to end
                first = inside or depth != 1
            cut_short = ends_range and last[name] == start
            content, ends = _braced(own, cut_short)
            where, odd, adds = _signs(content)
            odd = odd ^ inside
            nesting = depth + np.cumsum(np.where(odd == 1, 0, adds))
            done = np.searchsorted(where, ends)  # signs up to each piece's end
            odd, nesting = np.append(inside, odd)[done], np.append(depth, nesting)[done]
            closed = (odd == 0) & (nesting == 1)
            closed[len(closed) - cut_short:] = False
            inside, depth = int(odd[-1]), int(nesting[-1])
            stops = ends[closed]
            if len(stops) and (first or held):
                held.append(content[:stops[0]].tobytes())
                yield edge(True) if first else _rows(*at, None, True, without_lead(pa.array([b"".join(held)]).cast(pa.string())))
                held, first = [], 0
            else:
                stops = np.append(0, stops)
            if len(stops) > 1:
                texts = pa.StringArray.from_buffers(
                    len(stops) - 1, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(content))
                yield _rows(*at, None, True, without_lead(texts))
            if stops[-1] < len(content):
                held.append(content[stops[-1]:].tobytes())
            if ends_range and held:
                yield edge(False)

    # written once: its rows are read twice
    found = materialize(pieces.mapInArrow(cut, "file long, start long, side int, ended boolean, text string"), "json-elements")
    order = Window.partitionBy("file").orderBy("start", "side")
    edges = found.where("side is not null").withColumn("element", F.coalesce(
        F.sum(F.col("ended").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = edges.groupBy("file", "element").agg(
        F.max("ended").alias("ended"), F.array_sort(F.collect_list(F.struct("start", "side", "text"))).alias("parts"))
    joined = joined.where("ended").select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    joined = joined.mapInArrow(_strip, "text string")
    texts = found.where("side is null").select("text").unionByName(joined)
    return texts.select(F.from_json("text", schema).alias("j")).select("j.*")


def _rows(name: int, start: int, side: int | None, ended: bool, texts: pa.Array) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(v, t), n) for v, t in ((name, pa.int64()), (start, pa.int64()), (side, pa.int32()), (ended, pa.bool_()))]
        + [texts], names=["file", "start", "side", "ended", "text"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([without_lead(batch.column(0))], names=["text"])
