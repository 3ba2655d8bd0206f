"""Mixing sources to target weights with exact block quotas.

Documents fall into blocks by a seeded hash of the row, so a source's blocks
in number order are a random permutation of the source, and any run of blocks
is a random draw without replacement.  Per source the target is met by whole
passes plus the first blocks of one more pass; of the block in which the target
falls, the documents that still fit are taken in hash order.  What is left of
the target then goes to the documents of the later blocks, until it is below
the smallest one left; the smallest one is taken as well if that comes nearer.
All these documents form the last (partial) block of the quota.

The quotas are then dealt to output shards by a splitting tree: a node holds
how many blocks of every source its shards receive, and a draw from the
multivariate hypergeometric distribution decides how many go to its left half.
Every leaf thus has an exact quota per source and its own range of the
permuted blocks: shards are disjoint and need no talk with each other.  The
driver splits the top of the tree only; tasks split the subtrees.  Inside a
shard documents are ordered by another seeded hash.

Defined cases: a null or empty text has size 0 and is never taken; a null
source is a source of its own, last in order; rows equal in id and text share
a hash and are taken together; a source of size 0 has target 0; an empty table
gives no rows.  Extra columns pass through untouched.  The driver sees one row
per source (its size, number of blocks, and what is left of its target).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialize

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_COPIES = 2
DOCS_PER_BLOCK = 1024
SHARD_WORDS = 1 << 22
SEED = 8


@dataclass(frozen=True)
class SourcePlan:
    """One source: its number in code-point order, sizes and target."""

    source: str | None
    number: int
    size: int
    target: float

    @property
    def passes(self) -> int:
        return int(self.target // self.size) if self.size else 0

    @property
    def rest(self) -> float:
        return self.target - self.passes * self.size


def plan_targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS,
                 total_share: float = TOTAL_SHARE, max_copies: int = MAX_COPIES) -> list[SourcePlan]:
    """Targets by weight, no source above ``max_copies`` times its size; what
    a full source cannot take goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    size = np.array([n for _, n in order], np.float64)
    weight = np.array([weights[i % len(weights)] for i in range(len(order))], np.float64)
    target, full = np.zeros(len(order)), np.zeros(len(order), bool)
    budget = total_share * size.sum()
    while not full.all():
        left = budget - (max_copies * size[full]).sum()
        target = np.where(full, max_copies * size, left * weight / weight[~full].sum())
        over = ~full & (target > max_copies * size)
        if not over.any():
            break
        full |= over
        target = np.where(full, max_copies * size, target)
    return [SourcePlan(s, i, int(n), float(t)) for i, ((s, n), t) in enumerate(zip(order, target, strict=True))]


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _numbered(docs: DataFrame, id_col: str, text: str, source: str, n_blocks: int) -> DataFrame:
    """row, m_source, m_size, m_hash, m_block of every document."""
    h = F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text))
    return docs.select(F.struct("*").alias("row"), F.col(source).cast("string").alias("m_source"),
                       text_size(F.col(text)).alias("m_size"), h.alias("m_hash")).withColumn(
        "m_block", F.pmod(F.col("m_hash"), F.lit(n_blocks)))


def _running(blocks: DataFrame, width: int) -> DataFrame:
    """Blocks with the number and words of the source's blocks before each, by
    prefix sums over groups of ``width`` block numbers and within them."""
    group = F.floor(F.col("m_block") / width)
    blocks = blocks.withColumn("g", group)
    sums = blocks.groupBy("number", "g").agg(F.count(F.lit(1)).alias("gn"), F.sum("words").alias("gw"))
    before = Window.partitionBy("number").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("number", "g", F.coalesce(F.sum("gn").over(before), F.lit(0)).alias("bn"),
                       F.coalesce(F.sum("gw").over(before), F.lit(0)).alias("bw"))
    inside = Window.partitionBy("number", "g").orderBy("m_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.join(base, ["number", "g"]).select(
        "number", "m_block", "words",
        (F.col("bn") + F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0))).alias("rank"),
        (F.col("bw") + F.coalesce(F.sum("words").over(inside), F.lit(0))).alias("before"))


def _split(quota: np.ndarray, first: np.ndarray, lo: int, hi: int, depth: int) -> Iterator[tuple]:
    """Leaves (shard, first, quota) of the subtree of shards lo..hi-1; stops
    at ``depth`` with an inner node (lo, hi, first, quota)."""
    if hi - lo == 1 or depth == 0:
        yield lo, hi, first, quota
        return
    mid = (lo + hi) // 2
    total = int(quota.sum())
    rng = np.random.default_rng([SEED, lo, hi])
    # "marginals" draws source after source: cost by sources, not by blocks.
    left = rng.multivariate_hypergeometric(quota, total * (mid - lo) // (hi - lo), method="marginals")
    yield from _split(left, first, lo, mid, depth - 1)
    yield from _split(quota - left, first + left, mid, hi, depth - 1)


def split_quotas(spark, quotas: list[int], n_shards: int, top: int = 6) -> DataFrame:
    """(number, lo, hi, shard): which of a source's drawn blocks [lo, hi) go to
    which shard.  The driver splits ``top`` levels, tasks the rest."""
    quota = np.array(quotas, np.int64)
    # Eight bytes a source and node: a hundred thousand sources are a megabyte a node.
    nodes = [(int(lo), int(hi), f.tobytes(), q.tobytes())
             for lo, hi, f, q in _split(quota, np.zeros_like(quota), 0, n_shards, top)]
    tree = spark.createDataFrame(nodes, "lo int, hi int, first binary, quota binary")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for node in frame.itertuples():
                drawn = (np.frombuffer(x, np.int64) for x in (node.quota, node.first))
                for lo, _, first, own in _split(*drawn, node.lo, node.hi, -1):
                    some = np.flatnonzero(own)
                    yield pd.DataFrame({"number": some, "lo": first[some], "hi": (first + own)[some], "shard": lo})

    return tree.repartition(len(nodes)).mapInPandas(run, "number int, lo long, hi long, shard int").where("hi > lo")


def _part(room: Column) -> Column:
    """Whether a block is taken whole, cut, or not at all."""
    return F.when(F.col("before") + F.col("words") <= room, F.lit("all")).when(
        F.col("before") < room, F.lit("cut")).otherwise(F.lit("none"))


_FITS = "number int, m_block long, hashes array<long>, words long, cut boolean, spare_size long, spare_hash long"


def _fit_block(block: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block that fit the rest of a target, in hash order,
    and the smallest other one (a block holds about ``docs_per_block``
    documents whatever the corpus)."""
    block = block.sort_values("m_hash")
    room, taken, words, left = float(block["need"].iloc[0]), [], 0, []
    for h, size in zip(block["m_hash"].tolist(), block["size"].tolist(), strict=True):
        if words + size <= room:
            words += size
            taken.append(h)
        else:
            left.append((size, h))
    size, h = min(left)  # a cut block does not fit as a whole
    return pd.DataFrame({"number": [block["number"].iloc[0]], "m_block": [block["m_block"].iloc[0]], "hashes": [taken],
                         "words": [words], "cut": [True], "spare_size": [size], "spare_hash": [h]})


def _fill(sizes: DataFrame, cut: DataFrame) -> DataFrame:
    """(number, m_block, cut_hashes): the documents that fill the rest of every
    source's target, from the block in which it falls (``cut``) and, as far as
    that one leaves room, from the blocks after it.

    A round takes documents of at most half the room, in order, as far as they
    go, or the first one that fits where all are larger.  So the room halves
    with every round but the last, and all sources go through one round
    together.
    """
    spark = sizes.sparkSession
    cut_docs = sizes.where("m_size > 0").join(cut, F.expr("m_source <=> c_source and m_block = c_block"))
    first = cut_docs.groupBy("number", "m_block", "need", "m_hash").agg(F.sum("m_size").alias("size")).groupBy(
        "number").applyInPandas(_fit_block, _FITS)
    fits = [materialize(first, "mix-fits")]
    rooms = materialize(cut.join(fits[0].select("number", "words", "spare_size", "spare_hash"), "number").withColumn(
        "room", F.col("need") - F.col("words")).coalesce(1), "mix-rooms")
    room, spare = {}, {}
    for r in rooms.collect():
        room[r.number], spare[r.number] = r.room, (r.spare_size, r.c_block, r.spare_hash)

    # Documents that may still be taken: those that fit, and one above the room.
    pool = sizes.where("m_size > 0").join(rooms, F.expr("m_source <=> c_source and m_block > c_block and m_size < 2 * room"))
    pool = materialize(pool.groupBy("number", "m_block", "m_hash", "room").agg(F.sum("m_size").alias("size")).where(
        "size < 2 * room").select("number", "m_block", "m_hash", "size"), "mix-pool")
    while True:
        active = []
        for r in pool.groupBy("number").agg(F.min(F.struct("size", "m_block", "m_hash")).alias("least")).collect():
            if r.least.size <= room[r.number]:
                half = room[r.number] / 2
                active.append((r.number, room[r.number], half if r.least.size <= half else room[r.number]))
            else:
                spare[r.number] = min(spare[r.number], tuple(r.least))
        if not active:
            break
        rooms = materialize(spark.createDataFrame(active, "number int, room double, top double").coalesce(1), "mix-rooms")
        small = pool.join(rooms, "number").where("size <= top")
        ran = _running(small.groupBy("number", "m_block").agg(F.sum("size").alias("words")), 1024).join(rooms, "number")
        ran = materialize(ran.select("number", "m_block", _part(F.col("room")).alias("part"),
                                     (F.col("room") - F.col("before")).alias("need")), "mix-round")
        drawn = small.join(ran.where("part <> 'none'"), ["number", "m_block"])
        whole = drawn.where("part = 'all'").groupBy("number", "m_block").agg(
            F.collect_list("m_hash").alias("hashes"), F.sum("size").alias("words"), F.lit(False).alias("cut"),
            F.lit(None).cast("long").alias("spare_size"), F.lit(None).cast("long").alias("spare_hash"))
        last = drawn.where("part = 'cut'").select("number", "m_block", "m_hash", "size", "need").groupBy(
            "number").applyInPandas(_fit_block, _FITS)
        fits.append(materialize(whole.unionByName(last), "mix-fits"))
        went = fits[-1].groupBy("number").agg(
            F.sum("words").alias("words"), F.max(F.when(F.col("cut"), F.struct("spare_size", "m_block", "spare_hash"))).alias("end"))
        state = []
        for (number, _, top), r in zip(sorted(active), sorted(went.collect()), strict=True):
            room[number] -= r.words
            if r.end is not None:
                spare[number] = min(spare[number], tuple(r.end))
            state.append((number, room[number], top, None if r.end is None else r.end.m_block))
        state = materialize(spark.createDataFrame(state, "number int, room double, top double, upto long").coalesce(1), "mix-rooms")
        rest = materialize(pool.join(state, "number").where(  # without what was taken or passed over for good
            "size < 2 * room and (size > top or m_block > upto)").select("number", "m_block", "m_hash", "size"), "mix-pool")
        discard(pool)
        pool = rest

    nearer = [(n, block, [h]) for n, (size, block, h) in spare.items() if size - room[n] < room[n]]
    found = spark.createDataFrame(nearer, "number int, m_block long, hashes array<long>")
    for f in fits:
        found = found.unionByName(f.select("number", "m_block", "hashes"))
    return materialize(found.groupBy("number", "m_block").agg(F.flatten(F.collect_list("hashes")).alias("cut_hashes")), "mix-fills")


@dataclass(frozen=True)
class Mix:
    """``rows``: row, m_size, source_size, target and ``shards`` (array: one
    output shard per copy taken) of every document."""

    rows: DataFrame
    plans: list[SourcePlan]
    n_shards: int


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        docs_per_block: int = DOCS_PER_BLOCK, shard_words: int = SHARD_WORDS,
        weights: tuple[int, ...] = WEIGHTS, keep: list[str] | None = None) -> Mix:
    """Decide how often each document is taken, and into which shards.

    The texts are read twice, once for their sizes and once for the result; in
    between, block totals are shuffled, and (hash, size) of single documents
    only where they may fill what a block has left of a target.
    """
    spark = docs.sparkSession
    n_blocks = max(1, -(-docs.count() // docs_per_block))
    numbered = _numbered(docs, id_col, text, source, n_blocks)
    sizes = materialize(numbered.select("m_source", "m_block", "m_hash", "m_size"), "mix-sizes")
    by_block = materialize(sizes.groupBy("m_source", "m_block").agg(F.sum("m_size").alias("words")), "mix-blocks")
    plans = plan_targets([tuple(r) for r in by_block.groupBy("m_source").agg(F.sum("words")).collect()], weights)
    # Written, so that Spark knows its size: a small table is broadcast unasked.
    sources = materialize(spark.createDataFrame(
        [(p.source, p.number, p.size, p.target, p.passes, p.rest) for p in plans],
        "m_source string, number int, source_size long, target double, passes int, rest double").coalesce(1), "mix-sources")
    same = lambda a, b: a["m_source"].eqNullSafe(b["m_source"])
    blocks = by_block.join(sources, same(by_block, sources)).drop(by_block["m_source"])

    # Of the last pass a block is taken whole, cut, or not at all.
    ran = _running(blocks.select("number", "m_block", "words"), 1024)
    ran = materialize(ran.join(sources.select("number", "rest", "passes"), "number").withColumn(
        "part", _part(F.col("rest"))), "mix-ranks")
    cut = ran.where("part = 'cut'").select("number", "m_block", (F.col("rest") - F.col("before")).alias("need"))
    cut = materialize(cut.join(sources, "number").select(
        F.col("m_source").alias("c_source"), F.col("m_block").alias("c_block"), "number", "need"), "mix-cuts")
    fills = _fill(sizes, cut)
    discard(sizes)

    counts = ran.groupBy("number").agg(
        F.count(F.lit(1)).alias("blocks"), F.count(F.when(F.col("part") != "none", 1)).alias("more")).collect()
    per_source = {r.number: (r.blocks, r.more) for r in counts}
    quotas = [p.passes * per_source[p.number][0] + per_source[p.number][1] for p in plans]
    n_shards = max(1, round(sum(p.target for p in plans) / shard_words))
    dealt = split_quotas(spark, quotas, n_shards).select(
        "number", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("k"), "shard")

    # All that fills the rest of a target shares the draw of the block in which it falls.
    total = ran.groupBy("number").agg(F.count(F.lit(1)).alias("blocks"), F.count(F.when(F.col("part") == "all", 1)).alias("whole"))
    marked = ran.join(fills, ["number", "m_block"], "left").withColumn(
        "part", F.when(F.col("cut_hashes").isNotNull(), F.lit("cut")).otherwise(F.col("part"))).drop("cut_hashes")
    drawn = marked.join(total, "number").withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.col("passes")))).where("pass < passes or part <> 'none'")
    drawn = drawn.withColumn("k", F.col("pass") * F.col("blocks") + F.when(
        (F.col("pass") == F.col("passes")) & (F.col("part") == "cut"), F.col("whole")).otherwise(F.col("rank"))).join(dealt, ["number", "k"])
    copies = drawn.groupBy("number", "m_block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("draws"),  # at most one per pass
        F.max(F.when((F.col("pass") == F.col("passes")) & (F.col("part") == "cut"), F.col("passes"))).alias("cut_pass"))
    copies = copies.join(fills, ["number", "m_block"], "left").join(sources, "number").select(
        F.col("m_source").alias("c_source"), F.col("m_block").alias("c_block"), "draws", "cut_pass",
        F.when(F.col("cut_pass").isNotNull(), F.col("cut_hashes")).alias("cut_hashes"))

    taken = F.filter("draws", lambda d: F.col("cut_pass").isNull() | (d["pass"] < F.col("cut_pass"))
                     | F.coalesce(F.array_contains("cut_hashes", F.col("m_hash")), F.lit(False)))
    shards = F.when(F.col("m_size") > 0, F.coalesce(F.transform(taken, lambda d: d["shard"]), F.array().cast("array<int>"))
                    ).otherwise(F.array().cast("array<int>"))
    if keep is not None:
        numbered = numbered.withColumn("row", F.struct(*[F.col(f"row.{c}").alias(c) for c in keep]))
    copies = materialize(copies, "mix-draws")
    rows = numbered.join(copies, F.expr("m_source <=> c_source and m_block = c_block"), "left").select(
        "row", "m_source", "m_size", "m_hash", shards.alias("shards"))
    rows = rows.join(sources.select(F.col("m_source").alias("p_source"), "source_size", "target"),
                     F.expr("m_source <=> p_source"), "left")
    return Mix(rows.select("row", "m_size", "m_hash", "source_size", "target", "shards"), plans, n_shards)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix: every taken document with its own columns, once per copy, in
    its shard and there in the order of a seeded hash.  Neighbouring shards
    share a task, as many as keep the tasks within the session's shuffle
    partitions: shard after shard stands in a task's output."""
    mixed = mix(docs, **options)
    copies = mixed.rows.select("row", "m_hash", F.posexplode("shards").alias("copy", "shard"))
    order = F.xxhash64(F.lit(SEED + 1), F.col("m_hash"), F.col("copy"))
    tasks = min(mixed.n_shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    task = F.floor(F.col("shard").cast("long") * tasks / mixed.n_shards).cast("int")
    return copies.repartitionById(tasks, task).sortWithinPartitions("shard", order).select("row.*")
