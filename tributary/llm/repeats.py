"""Exact repeated substrings by a depth-limited radix sort of all suffixes.

A byte is removed if some string of ``depth`` bytes that covers it starts at
another place of the corpus too.  Suffixes need to be ordered through their
first ``depth`` bytes only, and only into equal and different: most-significant
digits first, every pass deals the suffixes that are still together by their
next digit, and a suffix that is alone is done.  What is together after
``depth`` bytes are exactly the repeated strings.

The first digit is chosen so that a corpus can be dealt by it: the window's
least gram of ``GRAM`` bytes by a hash.  It depends on the window's content
alone, so equal windows share it, and neighbouring windows mostly have the same
one: a run of windows with one gram (up to ``depth - GRAM + 1`` of them) travels
as one row, about one row per 85 bytes of text.

* Pass 1 counts runs by their gram.  Alone: nothing repeats (most runs).
* Pass 2 counts runs by their whole stretch of text.  Equal stretches are
  repeated from end to end (copies, near copies away from their edits).
* The rest, runs with a known gram and a stretch of their own, are the edges of
  repeats.  Their texts are fetched, and their windows, dealt by gram, are
  radix-sorted in digits of ``WORDS * 8`` bytes.  A gram with more than
  ``GROUP`` different stretches is not gathered: its windows are counted by one
  shuffled digit of all ``depth`` bytes, with partial counts on the map side.

Counts decide at every step, with partial aggregates, and rows are joined back
to them, so a passage that a third of all documents share puts nothing into
one task.  Texts are known by 128 bits of hash: equal texts have equal results
and are asked for once.

Defined cases: a null text is empty; texts shorter than ``depth`` lose nothing;
copies of a text remove each other whole; overlapping repeats inside one text
count (``aaa...``); matches never run across documents; an empty table has no
rows; other columns travel in ``row``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, materialize
from .suffix_arrays import spread
from .textmap import bound_batches, byte_groups, text_bytes

DEPTH = 200
GRAM = 32
#: Different stretches of one gram that are sorted in one task.
GROUP = 1024
#: 64-bit words of a digit.
WORDS = 5
#: Windows that are sorted together.
SORTED_AT_ONCE = 1 << 17

_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Grams:
    """Hashes of all grams of a text (a polynomial modulo 2^64, mixed)."""

    def __init__(self, size: int) -> None:
        self.size, self.up, self.down = size, np.ones(0, np.uint64), np.ones(0, np.uint64)

    def __call__(self, text: np.ndarray) -> np.ndarray:
        n = len(text)
        if len(self.up) < n:
            self.up = np.cumprod(np.full(n, _ODD, np.uint64))
            self.down = np.cumprod(np.full(n, _BACK, np.uint64))
        total = np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[:n])
        found = total[self.size - 1:].copy()
        found[1:] -= total[:n - self.size]
        found *= self.down[:len(found)]
        found ^= found >> np.uint64(29)
        found *= _MIX
        found ^= found >> np.uint64(32)
        return found


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs(texts: Sequence[bytes], grams: Grams, depth: int) -> tuple[np.ndarray, ...]:
    """Per run: the text's number, its gram, first byte, number of bytes, and
    whether the gram stands in it at several places (then windows of the run
    may equal each other)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - depth + 1, 0)
    if not windows.any():
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none.astype(bool)
    hashes = grams(np.frombuffer(b"".join(texts), np.uint8))
    width = depth - grams.size + 1
    place = np.arange(len(hashes), dtype=np.uint64)
    least = sliding_min((hashes >> np.uint64(32) << np.uint64(32)) | place, width)
    at = spread(first, windows)  # the windows inside a text
    chosen = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Windows by the place of their gram, then by its value, cut at ``width``.
    turn = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    gram = hashes[chosen[turn]]
    owner = np.searchsorted(first + sizes, at[turn], "right")
    new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])])
    start, of = turn[new], np.flatnonzero(new)
    length = np.diff(np.append(start, len(at)))
    pieces = -(-length // width)
    begin = spread(np.zeros(len(start), np.int64), pieces) * width + np.repeat(start, pieces)
    count = np.minimum(width, np.repeat(start + length, pieces) - begin)
    places = np.searchsorted(turn, begin + count) - np.searchsorted(turn, begin, "right")
    of = np.repeat(of, pieces)
    return owner[of], gram[of], at[begin] - first[owner[of]], count + depth - 1, places > 0


_RUN = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("gram", pa.int64()), ("stretch", pa.int64()),
                  ("at", pa.int64()), ("size", pa.int64()), ("several", pa.bool_())])


def key(text: str | Column) -> list[Column]:
    """128 bits of hash that stand for a text (null: empty)."""
    whole = F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit("second"), whole).alias("k2")]


def all_runs(docs: DataFrame, text: str, depth: int) -> DataFrame:
    """The runs of all texts: (k1, k2, gram, stretch, at, size, several)."""
    bound_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        grams = Grams(min(GRAM, depth))
        for batch in batches:
            texts = batch.column(2)
            for a, b in byte_groups(texts):
                group = [t or b"" for t in text_bytes(texts.slice(a, b - a))]
                owner, gram, at, size, several = runs(group, grams, depth)
                views = [memoryview(t) for t in group]
                stretch = np.fromiter((xxhash.xxh3_64_intdigest(views[o][x:x + n]) for o, x, n in
                                       zip(owner.tolist(), at.tolist(), size.tolist(), strict=True)),
                                      np.uint64, len(at))
                rows = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(gram.view(np.int64)),
                     pa.array(stretch.view(np.int64)), pa.array(at), pa.array(size), pa.array(several)], schema=_RUN)

    own = docs.select(*key(text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(scan, "k1 long, k2 long, gram long, stretch long, at long, size long, several boolean")


def together(group: np.ndarray, text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Which of the windows starting at ``at`` equal another one of their group.

    Radix sort, most significant digit first: windows that share all digits so
    far are dealt by the next one; a window that is alone drops out.
    """
    width = 8 * ((depth + 7) // 8)
    padded = np.concatenate([text, np.zeros(width + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(">u8").ravel().astype(np.uint64)
    tail = depth % 8  # the last word of a window holds only so many of its bytes
    rest = np.arange(len(at))
    group = group.astype(np.uint64)
    for low in range(0, depth, 8 * WORDS):
        digit = []
        for x in range(low, min(low + 8 * WORDS, depth), 8):
            word = words[at[rest] + x]
            if x + 8 > depth:
                word = word >> np.uint64(64 - 8 * tail)
            digit.append(word)
        mixed = group * np.uint64(_ODD)
        for word in digit:
            mixed = (mixed ^ word) * _MIX
            mixed ^= mixed >> np.uint64(31)
        order = np.argsort(mixed)
        differs = _edges([group, *digit], order)
        if differs.sum() != _edges([mixed], order).sum():  # two digits with one hash: sort by the digits themselves
            order = np.lexsort([*digit[::-1], group])
            differs = _edges([group, *digit], order)
        number = np.cumsum(differs) - 1
        kept = np.bincount(number)[number] > 1
        rest, group = rest[order[kept]], number[kept].astype(np.uint64)
        if not len(rest):
            break
    found = np.zeros(len(at), bool)
    found[rest] = True
    return found


def _edges(columns: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    differs = np.zeros(len(order), bool)
    differs[:1] = True
    for column in columns:
        sorted_ = column[order]
        differs[1:] |= sorted_[1:] != sorted_[:-1]
    return differs


def covered(repeated: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte ranges covered by the windows marked in ``repeated``."""
    edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1 + depth
    return start, end


_SPAN = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_SPAN_DDL = "k1 long, k2 long, a long, b long"


def sort_edges(stretches: DataFrame, depth: int) -> DataFrame:
    """Spans (k1, k2, a, b) of the repeats in stretches that occur once.

    ``stretches``: (gram, stretch, n, k1, k2, at, bytes) with all stretches of
    each gram; rows may come several times.
    """
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        last, seen, windows = None, set(), 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["gram"] != last:
                    if windows >= SORTED_AT_ONCE:
                        yield _sorted_spans(held, depth)
                        held, windows = [], 0
                    last, seen = row["gram"], set()
                if row["stretch"] not in seen:
                    seen.add(row["stretch"])
                    held.append(row)
                    windows += len(row["bytes"]) - depth + 1
        if held:
            yield _sorted_spans(held, depth)

    return stretches.repartition("gram").sortWithinPartitions("gram").mapInArrow(sort, _SPAN_DDL)


def _sorted_spans(rows: list[dict], depth: int) -> pa.RecordBatch:
    sizes = np.array([len(r["bytes"]) for r in rows], np.int64)
    first, windows = np.cumsum(sizes) - sizes, sizes - depth + 1
    number = {g: i for i, g in enumerate(dict.fromkeys(r["gram"] for r in rows))}
    group = np.repeat([number[r["gram"]] for r in rows], windows)
    found = together(group, np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8), spread(first, windows), depth)
    out, at = [], 0
    for row, n in zip(rows, windows.tolist(), strict=True):
        if row["n"] == 1:
            for a, b in zip(*covered(found[at:at + n], depth), strict=True):
                out.append((row["k1"], row["k2"], row["at"] + int(a), row["at"] + int(b)))
        at += n
    columns = zip(*out, strict=True) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SPAN)


def count_windows(stretches: DataFrame, depth: int) -> DataFrame:
    """The same for grams with very many stretches: one digit of ``depth``
    bytes, counted by a shuffle with partial counts instead of gathered.  A
    digit that counts one names its only window, so the count itself gives what
    is alone; a stretch that occurs once is repeated everywhere else."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for batch in batches:
            for row in batch.to_pylist():
                text = row["bytes"]
                digits = b"".join(xxhash.xxh3_128_digest(text[i:i + depth]) for i in range(len(text) - depth + 1))
                pair = np.frombuffer(digits, ">i8").astype(np.int64).reshape(-1, 2)
                many = len(pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * many, pa.int64()) for c in ("gram", "stretch", "n")]
                    + [pa.array(np.arange(many)), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                    names=["gram", "stretch", "n", "i", "d1", "d2"])

    once = stretches.select("gram", "stretch", "n", "bytes").dropDuplicates(["gram", "stretch"])
    windows = once.mapInArrow(cut, "gram long, stretch long, n long, i long, d1 long, d2 long")
    alone = windows.groupBy("gram", "d1", "d2").agg(
        F.sum("n").alias("many"), F.min("stretch").alias("stretch"), F.min("i").alias("i")).where("many = 1")
    # at most one number per window of a stretch
    alone = alone.groupBy("gram", "stretch").agg(F.array_sort(F.collect_list("i")).alias("alone"))
    own = stretches.where("n = 1").select(
        "gram", "stretch", "k1", "k2", "at", (F.length("bytes") - F.lit(depth - 1)).cast("long").alias("windows"))
    own = own.dropDuplicates(["gram", "stretch"]).join(alone, ["gram", "stretch"], "left").withColumn(
        "ends", F.concat(F.coalesce("alone", F.array().cast("array<long>")), F.array("windows")))
    hit = F.expr(f"""filter(transform(ends, (y, j) -> struct(at + if(j = 0, 0L, get(ends, j - 1) + 1) as a,
                                                             at + y + {depth - 1} as b)), s -> s.b - s.a >= {depth})""")
    return own.select("k1", "k2", F.inline(hit))


def fetch(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted stretches: (gram, stretch, n, many, k1, k2, at, bytes)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # copies of a text are asked once in a task
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for i, (k1, k2, lists) in enumerate(zip(*[batch.column(c).to_pylist() for c in (0, 1, 3)], strict=True)):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[c] for w in lists], pa.int64()) for c in ("gram", "stretch", "n", "many")]
                    + [pa.array([k] * len(lists), pa.int64()) for k in (k1, k2)]
                    + [pa.array([w["at"] for w in lists], pa.int64()),
                       pa.array([texts[i][w["at"]:w["at"] + w["size"]] for w in lists], pa.binary())],
                    names=["gram", "stretch", "n", "many", "k1", "k2", "at", "bytes"])

    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "stretch", "n", "many", "at", "size")).alias("w"))
    lists = materialize(lists, "repeat-lists", free_shuffles=True)
    own = docs.select(*key(text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return own.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "w").mapInArrow(
        cut, "gram long, stretch long, n long, many long, k1 long, k2 long, at long, bytes binary")


def repeated_spans(docs: DataFrame, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(k1, k2, spans): per text (by its ``key``) with repeats, the byte ranges
    they cover, unordered and overlapping."""
    found = materialize(all_runs(docs, text, depth), "repeat-runs", free_shuffles=True)
    # Pass 1: grams.
    grams = found.groupBy("gram").agg(
        F.count(F.lit(1)).alias("runs"), F.min("stretch").alias("lo"), F.max("stretch").alias("hi"),
        F.max("several").alias("several"))
    grams = grams.where("runs > 1 or several").select("gram", (F.expr("lo <> hi") | F.col("several")).alias("mixed"))
    known = materialize(found.join(materialize(grams, "repeat-grams", free_shuffles=True), "gram"),
                        "repeat-known", free_shuffles=True)
    discard(found)
    # Pass 2: whole stretches.
    whole = known.where("not mixed").select("k1", "k2", "at", "size")
    mixed = known.where("mixed")
    stretches = mixed.groupBy("gram", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.max("several").alias("several"),
        F.min(F.struct("k1", "k2", "at", "size")).alias("place"))
    stretches = materialize(stretches, "repeat-stretches", free_shuffles=True)
    copies = mixed.join(stretches.where("n > 1").select("gram", "stretch"), ["gram", "stretch"], "left_semi").select(
        "k1", "k2", "at", "size")
    # The edges: stretches of their own, and what shares their gram.
    edges = stretches.groupBy("gram").agg(F.count(F.lit(1)).alias("many"), F.min("n").alias("least")).where("least = 1")
    edges = materialize(edges, "repeat-edges", free_shuffles=True)  # a join on a shuffle of its own splits a hot gram
    wanted = stretches.join(edges, "gram").select("gram", "stretch", "n", "many", "place.*")
    cut = materialize(fetch(docs, text, wanted), "repeat-cut", free_shuffles=True)
    spans = whole.unionByName(copies).select("k1", "k2", F.col("at").alias("a"), (F.col("at") + F.col("size")).alias("b"))
    spans = spans.unionByName(sort_edges(cut.where(F.col("many") <= GROUP), depth))
    if not cut.where(F.col("many") > GROUP).isEmpty():
        spans = spans.unionByName(count_windows(cut.where(F.col("many") > GROUP), depth))
    spans = materialize(spans.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans")),
                        "repeat-spans", free_shuffles=True)
    for frame in (known, stretches, edges, cut):
        discard(frame)
    return spans


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by any span."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, text: str = "text", depth: int = DEPTH, keep: Sequence[str] | None = None,
                   with_kept: bool = True) -> DataFrame:
    """``row`` (the kept columns) and ``res`` per document: n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256, the spans, and ``kept``, the
    bytes that stay (a cut may fall inside a character)."""
    spans = repeated_spans(docs, text, depth)
    own = docs.select(*key(text), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                      (F.struct("*") if keep is None else F.struct(*keep)).alias("row"))
    joined = own.join(spans, ["k1", "k2"], "left").select("row", "text", "spans")
    result = T.StructType([T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept_sha256", T.StringType()),
                             T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))]
                          + [T.StructField("kept", T.BinaryType())] * with_kept)
    types = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.list_(pa.int64()))] + [pa.binary()] * with_kept

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for whole, listed in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                cut = merged(listed)
                ends = [0, *(b for _, b in cut)]
                parts = [whole[a:b] for a, b in zip(ends, [*(a for a, _ in cut), len(whole)], strict=True)]
                digest = hashlib.sha256()
                for part in parts:
                    digest.update(part)
                rows.append((len(whole), sum(b - a for a, b in cut), len(cut), digest.hexdigest(), cut)
                            + ((b"".join(parts),) if with_kept else ()))
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            res = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=result.fieldNames())
            yield pa.RecordBatch.from_arrays([batch.column(0), res], names=["row", "res"])

    row_type = joined.schema["row"].dataType
    return joined.mapInArrow(remove, T.StructType([T.StructField("row", row_type), T.StructField("res", result)]))
