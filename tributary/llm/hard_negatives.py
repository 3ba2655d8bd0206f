"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors are quantised to integers.  Candidates are ordered by label and, within
a label, along a Hilbert curve through their most spread dimensions, and cut
into blocks of ``BLOCK_ROWS`` neighbours, one Parquet row each.  Beside its
vectors a block has its zone map: the least and greatest value of every
dimension, and its range of labels.

Interval arithmetic on an anchor and a zone map bounds every inner product that
the block can hold: the upper bound takes the greatest value where the anchor
is positive and the least where it is negative, the lower bound the other way
round.  A search over a window of scores reads, per window, first the block
with the highest upper bound; the k-th best score found there is a floor, and
then every other block whose bounds meet the window above the floor is read,
and no more.  The search is exact: a block is left out only if none of its rows
can be in the answer.

* Positives: the best rows of the anchor's label, window without limits.
* Negatives: per positive, the best rows of other labels with 0.50 to 0.95 of
  its score.

Anchors travel in chunks of ``CHUNK_ROWS``, zone maps in pages of
``PAGE_BLOCKS``; each (chunk, page) and each (chunk, block) is a unit of work of
bounded size, whatever label or region is hot, and only a few best rows per
window leave it.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component, take no part; vectors of different length are padded with
zeros; repeated rows are rows of their own (an anchor never meets itself, but
it meets its copy); ties go to the smaller id; scores beyond 64 bits are
returned as the nearest 64-bit number; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ordered import row_numbers
from ..session import discard, materialize

BLOCK_ROWS = 512
CHUNK_ROWS = 256
PAGE_BLOCKS = 256
#: The curve runs through so many dimensions, with so many bits of each.
CURVE_DIMS, CURVE_BITS = 12, 5
#: So few chosen blocks are named in the read, so that the scan skips the rest.
NAMED_BLOCKS = 1000

N_POSITIVES, N_NEGATIVES = 5, 3


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each cell (rows of unsigned coordinates below 2^bits) on the
    Hilbert curve, by Skilling's transposition."""
    x = cells.astype(np.uint64).T.copy()
    n, one = len(x), np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, p = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] & np.uint64(1 << b)) != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= flip
    place = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << one | (x[i] >> np.uint64(b) & one)
    return place


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of integers floor(256 * x) (in doubles), zero-padded."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = values
    return np.floor(out * 256)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two sets of integer rows, exact; a score that
    64 bits don't hold becomes the nearest that they do."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if most < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def in_window(scores: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """50 * positive <= 100 * score <= 95 * positive, without overflow."""
    if max(np.abs(scores.astype(float)).max(initial=0), np.abs(positive.astype(float)).max(initial=0)) > 2.0 ** 57:
        scores, positive = scores.astype(object), positive.astype(object)
    return ((positive <= 2 * scores) & (20 * scores <= 19 * positive)).astype(bool)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with anything inside
    each box, a little widened for rounding."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    slack = np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T * 2.0 ** -44
    return plus @ low.T + minus @ high.T - slack, plus @ high.T + minus @ low.T + slack


def usable(vec_id: str, vector: str, label: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite


def shifted_label(vec_id: str = "vec_id", label: str = "label") -> Column:
    """The contract's label: one further, modulo 10, where 7 divides the id."""
    return F.when(F.col(vec_id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label)).cast("long")


def _spread(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and deviation of every dimension, over all rows (``width`` rows
    come to the driver), and the dimensions by falling deviation."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            m = matrix(batch.column(0), width)
            n, total, square = n + len(m), total + m.sum(0), square + (m * m).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), pa.array([n] * width, pa.int64()),
                                          pa.array(total), pa.array(square)], names=["d", "n", "t", "s"])

    found = rows.select("v").mapInArrow(sums, "d long, n long, t double, s double").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("s").alias("s")).orderBy("d").collect()
    n = max(1, found[0].n) if found else 1
    mean = np.array([r.t / n for r in found])
    deviation = np.sqrt(np.maximum(0, np.array([r.s / n for r in found]) - mean * mean))
    return mean, deviation, np.argsort(-deviation, kind="stable")


def _on_curve(rows: DataFrame, width: int) -> DataFrame:
    """Adds ``curve``: the Hilbert place of each vector."""
    mean, deviation, order = _spread(rows, width)
    dims = order[:CURVE_DIMS]
    low, step = (mean - 2 * deviation)[dims], (4 * deviation / (1 << CURVE_BITS))[dims]
    step = np.where(step > 0, step, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch.column(2), width)[:, dims]
            cells = np.clip(np.floor((m - low) / step), 0, (1 << CURVE_BITS) - 1)
            at = hilbert(cells, CURVE_BITS) if len(dims) else np.zeros(len(m), np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64))],
                                             names=[*batch.schema.names, "curve"])

    return rows.mapInArrow(place, "vec_id long, label long, v array<double>, curve long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows sorted by the first column, group by group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != keys[a]:
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held).combine_chunks()


_BLOCK = "rows binary, ids binary, labels binary, vectors binary, low binary, high binary, low_label long, high_label long"


def _packed(rows: DataFrame, key: str, width: int) -> DataFrame:
    """One row per ``key`` with its rows, by falling id order, as numpy bytes,
    and its zone map.  ``rows``: (key, row, vec_id, label, v)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, t in _groups(batches):
            ids, labels = t.column("vec_id").to_numpy(), t.column("label").to_numpy()
            m = matrix(t.column("v").combine_chunks(), width)
            own = (t.column("row").to_numpy(), ids, labels, m, m.min(0), m.max(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), *[pa.array([x.tobytes()], pa.binary()) for x in own],
                 pa.array([labels.min()]), pa.array([labels.max()])],
                names=[key, "rows", "ids", "labels", "vectors", "low", "high", "low_label", "high_label"])

    dealt = rows.select(key, "row", "vec_id", "label", "v").repartition(key).sortWithinPartitions(key, "vec_id", "row")
    return dealt.mapInArrow(pack, f"{key} long, {_BLOCK}")


def _ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _rows_of(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, width) if width else np.zeros((0, 0))


class Candidates:
    """The stored blocks and their zone maps."""

    def __init__(self, rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                 label: Column | str = "label") -> None:
        """``rows`` needs the three columns; ``label`` may be an expression."""
        plain = label if isinstance(label, str) else "label"
        own = rows.where(usable(vec_id, vector, plain)).select(
            F.col(vec_id).cast("long").alias("vec_id"),
            (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
            F.col(vector).cast("array<double>").alias("v"))
        self.width = own.agg(F.max(F.size("v"))).first()[0] or 0
        numbered = row_numbers(_on_curve(own, self.width), ["label", "curve", "vec_id"], out="row")
        self.rows = materialize(numbered.withColumn("block", F.floor((F.col("row") - 1) / BLOCK_ROWS)), "vectors")
        # A row group is a block: a read that names its blocks skips all others.
        self.blocks = materialize(_packed(self.rows, "block", self.width), "vector-blocks",
                                  **{"parquet.block.row.count.limit": "1"})
        zones = self.blocks.select(F.floor(F.col("block") / PAGE_BLOCKS).alias("page"),
                                   F.struct("block", "low", "high", "low_label", "high_label").alias("zone"))
        self.pages = materialize(zones.groupBy("page").agg(F.collect_list("zone").alias("zones")), "vector-zones")
        self.n_pages = self.pages.count()

    def discard(self) -> None:
        for frame in (self.rows, self.blocks, self.pages):
            discard(frame)


WINDOWS = "array<struct<of: int, positive: long>>"


def _units(queries: DataFrame, found: Candidates, floors: DataFrame | None, same: bool, width: int) -> DataFrame:
    """Which blocks the windows of each chunk must read.  Without ``floors``:
    (chunk, w, block, bound), the most promising block of each window on each
    page.  With them: (chunk, block, ws, least), every further block that can
    matter, and the least score that still does."""
    each = queries.select("chunk", "labels", "vectors", "windows",
                          F.explode(F.sequence(*[F.lit(p).cast("long") for p in (0, found.n_pages - 1)])).alias("page"))
    each = each.join(found.pages, "page")
    if floors is not None:
        each = each.join(floors, "chunk", "left")

    def reach(row: dict) -> tuple[np.ndarray, ...]:
        zones, windows = row["zones"], row["windows"]
        low, high = (np.vstack([_rows_of(z[c], width) if width else np.zeros((1, 0)) for z in zones]) for c in ("low", "high"))
        of = np.array([w["of"] for w in windows])
        anchors, labels = _rows_of(row["vectors"], width) if width else np.zeros((of.max() + 1, 0)), _ints(row["labels"])
        least, most = bounds(anchors, low, high)
        least, most, label = least[of], most[of], labels[of][:, None]
        low_label, high_label = (np.array([z[c] for z in zones]) for c in ("low_label", "high_label"))
        can = (low_label <= label) & (label <= high_label) if same else (low_label != label) | (high_label != label)
        if not same:  # the window of each positive, a little widened
            score = np.array([w["positive"] for w in windows], np.float64)[:, None]
            pad = np.abs(score) * 2.0 ** -44 + 0.5
            can &= (most >= score * 0.5 - pad) & (least <= score * 0.95 + pad) & (score >= 0)
            most = np.minimum(most, score * 0.95 + pad)
        return np.array([z["block"] for z in zones]), can, most

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, can, most = reach(row)
                value = np.where(can, most, -np.inf)
                best = value.argmax(1)
                w = np.flatnonzero(can.any(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(w), pa.int64()), pa.array(w, pa.int32()),
                     pa.array(block[best[w]]), pa.array(value[w, best[w]])], names=["chunk", "w", "block", "bound"])

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, can, most = reach(row)
                least = np.full(len(can), np.iinfo(np.int64).min)
                for f in row["floors"] or ():
                    can[f["w"]] &= block != f["block"]
                    if f["floor"] is not None:
                        can[f["w"]] &= most[f["w"]] >= f["floor"]
                        least[f["w"]] = f["floor"]
                used = np.flatnonzero(can.any(0))
                ws = [np.flatnonzero(can[:, b]) for b in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(used), pa.int64()), pa.array(block[used]),
                     pa.array([w.tolist() for w in ws], pa.list_(pa.int32())),
                     pa.array([least[w].tolist() for w in ws], pa.list_(pa.int64()))],
                    names=["chunk", "block", "ws", "least"])

    if floors is None:
        return each.mapInArrow(first, "chunk long, w int, block long, bound double")
    return each.mapInArrow(further, "chunk long, block long, ws array<int>, least array<long>")


def _read(units: DataFrame, queries: DataFrame, found: Candidates, same: bool, k: int, width: int) -> DataFrame:
    """The best rows of each unit: (chunk, w, score, vec_id)."""
    chosen = [r.block for r in units.select("block").distinct().limit(NAMED_BLOCKS + 1).collect()]
    blocks = found.blocks if len(chosen) > NAMED_BLOCKS else found.blocks.where(F.col("block").isin(chosen))
    blocks = blocks.select("block", *[F.col(c).alias(f"c_{c}") for c in ("rows", "ids", "labels", "vectors")])
    joined = units.join(blocks, "block").join(queries, "chunk")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ws = np.array(row["ws"])
                of = np.array([row["windows"][w]["of"] for w in row["ws"]])
                ids, labels = _ints(row["c_ids"]), _ints(row["c_labels"])
                own, where = np.unique(of, return_inverse=True)
                anchors = _rows_of(row["vectors"], width)[own] if width else np.zeros((len(own), 0))
                block = _rows_of(row["c_vectors"], width) if width else np.zeros((len(ids), 0))
                scores = inner(anchors, block)[where]
                least = np.array(row["least"], np.int64)[:, None] if row["least"] else np.iinfo(np.int64).min
                ok = (_ints(row["labels"])[of][:, None] == labels) == same
                ok &= (_ints(row["rows"])[of][:, None] != _ints(row["c_rows"])) & (scores >= least)
                if not same:
                    ok &= in_window(scores, np.array([row["windows"][w]["positive"] for w in row["ws"]], np.int64)[:, None])
                for _ in range(k):  # rows stand by rising id: the first of equal scores is the smaller id
                    value = np.where(ok, scores, np.iinfo(np.int64).min)
                    best = value.argmax(1)
                    best = np.where(ok[np.arange(len(ws)), best], best, ok.argmax(1))
                    hit = np.flatnonzero(ok[np.arange(len(ws)), best])
                    if not len(hit):
                        break
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["chunk"]] * len(hit), pa.int64()), pa.array(ws[hit], pa.int32()),
                         pa.array(scores[hit, best[hit]]), pa.array(ids[best[hit]])],
                        names=["chunk", "w", "score", "vec_id"])
                    ok[hit, best[hit]] = False

    return joined.mapInArrow(read, "chunk long, w int, score long, vec_id long")


def search(queries: DataFrame, found: Candidates, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows of every window: (chunk, w, rank, score, vec_id).

    ``queries``: (chunk, rows, ids, labels, vectors, windows); ``same`` asks for
    rows of the anchor's own label, else for others within the window of each
    positive score.
    """
    width, window = found.width, Window.partitionBy("chunk", "w").orderBy(F.desc("score"), "vec_id")
    best = _units(queries, found, None, same, width).groupBy("chunk", "w").agg(F.max_by("block", "bound").alias("block"))
    best = materialize(best, "first-blocks")
    units = best.groupBy("chunk", "block").agg(F.collect_list("w").alias("ws")).withColumn(
        "least", F.lit(None).cast("array<long>"))
    start = materialize(_read(units, queries, found, same, k, width), "first-rows")
    floors = start.groupBy("chunk", "w").agg(F.when(F.count("score") >= k, F.min("score")).alias("floor"))
    floors = best.join(floors, ["chunk", "w"], "left").groupBy("chunk").agg(
        F.collect_list(F.struct("w", "block", "floor")).alias("floors"))
    more = materialize(_units(queries, found, floors, same, width), "further-blocks")
    rows = start.unionByName(_read(more, queries, found, same, k, width))
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding",
         label: Column | str = "label") -> DataFrame:
    """Hard negatives of all rows for which ``is_anchor`` (an expression on
    vec_id and label) holds: (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score)."""
    found = Candidates(rows, vec_id, vector, label)
    anchors = row_numbers(found.rows.where(is_anchor), ["row"], out="place")
    anchors = anchors.withColumn("chunk", F.floor((F.col("place") - 1) / CHUNK_ROWS))
    chunks = materialize(_packed(anchors, "chunk", found.width).select("chunk", "rows", "ids", "labels", "vectors"), "anchors")
    if not found.n_pages:
        return chunks.select(F.lit(0).cast("long").alias("anchor_id"), F.lit(0).cast("long").alias("positive_id"),
                             F.lit(0).alias("rank"), F.lit(0).cast("long").alias("negative_id"),
                             F.lit(0).cast("long").alias("positive_score"), F.lit(0).cast("long").alias("negative_score"))
    count = (F.octet_length("rows") / 8).cast("int")
    whole = chunks.withColumn("windows", F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
        i.alias("of"), F.lit(None).cast("long").alias("positive"))))
    positives = materialize(search(whole, found, True, N_POSITIVES), "positives")
    listed = positives.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("w", "rank", "score", "vec_id"))).alias("p"))
    listed = materialize(listed, "positive-lists")
    windows = chunks.join(listed, "chunk").withColumn("windows", F.transform("p", lambda x: F.struct(
        x["w"].alias("of"), x["score"].alias("positive")))).drop("p")
    negatives = search(windows, found, False, N_NEGATIVES)
    names = listed.select("chunk", F.posexplode("p").alias("w", "p"))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = _ints(row["ids"])
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]] * len(own), pa.int64()),
                                                  pa.array(np.arange(len(own)), pa.int32()), pa.array(own)],
                                                 names=["chunk", "of", "anchor_id"])

    anchor_ids = chunks.select("chunk", "ids").mapInArrow(ids, "chunk long, of int, anchor_id long")
    return (negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
            .join(names, ["chunk", "w"]).join(anchor_ids.withColumnRenamed("chunk", "c"),
                                              (F.col("chunk") == F.col("c")) & (F.col("p.w") == F.col("of")))
            .select("anchor_id", F.col("p.vec_id").alias("positive_id"), "rank", "negative_id",
                    F.col("p.score").alias("positive_score"), "negative_score"))
