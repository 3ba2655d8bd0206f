"""SimHash near-duplicates, linked through Golay-code keys.

A fingerprint is cut into three segments (22, 21 and 21 bits).  Of at most 4
differing bits, spread over the segments:

* if a segment does not differ, one of the other two differs in 2 bits at
  most: key = the equal segment + a nearby codeword index of the other;
* if every segment differs, two of them differ in exactly 1 bit and the third
  in 2 at most, so one of the third's three parts is equal: key = the decoded
  index of one segment + a nearby index of the other (and the reverse) + the
  equal part.

So any two fingerprints that link share a key of 33 bits or more.  Equal
fingerprints are one node throughout.  A key's fingerprints are compared by
bit distance; a key with very many is cut into blocks whose pairs are compared
by separate tasks.  A first round with decoded indices only joins most of a
large group of near copies cheaply; the second round then reports links
between different first-round groups only.

Defined cases: a text without words (null, empty, white space) has the
fingerprint zero and links like any other; fewer words than a shingle form one
shingle; rows that repeat a doc_id are rows of their own; a null doc_id can
belong to a component but never names it (the component of null ids only is
null).  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import golay
from .components import connected_components
from .textmap import lower_space_words, map_texts

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: A key with more fingerprints than this is compared block by block.
BLOCK = 1 << 16

_SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
_FINGERPRINT = T.StructType([T.StructField("fingerprint", T.LongType())])


def fingerprints(texts: list[bytes | None], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The 64-bit fingerprint of every text, as signed integers."""
    digests: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_digest
    for i, text in enumerate(texts):
        words = lower_space_words(text)
        if not words:
            continue
        if len(words) < shingle:
            digests.append(digest(b" ".join(words), SEED))
            counts[i] = 1
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
        starts = [0] + [e + 1 for e in ends[:-shingle]]
        digests += [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=True)]
        counts[i] = len(starts)
    out = np.zeros(len(texts), np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        first = np.cumsum(counts[some]) - counts[some]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        packed = np.packbits(2 * ones > counts[some][:, None], axis=1)
        out[some] = packed.view(">u8").ravel().astype(np.uint64).view(np.int64)
    return out


def with_fingerprints(docs: DataFrame, keep: list, text: str = "text",
                      shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The kept columns and ``fingerprint`` (signed 64-bit) of every row."""
    def kernel():
        return lambda texts: [pa.array(fingerprints(texts, shingle))]
    return map_texts(docs, text, kernel, _FINGERPRINT, keep=keep, group_bytes=1 << 19).select("row.*", "res.fingerprint")


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of signed 64-bit numbers (a signed count would take the absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    return [(fps >> first) & ((1 << bits) - 1) for first, bits in _SEGMENTS]


def centre_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): an equal segment and the decoded index of another."""
    seg = _segments(fps)
    index = [golay.decode(s) for s in seg]
    rows, keys = [], []
    for i in range(3):
        for j in range(3):
            if i != j:
                rows.append(np.arange(len(fps)))
                keys.append((3 * i + j) << 40 | seg[i] << 12 | index[j])
    return np.concatenate(rows), np.concatenate(keys)


def all_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every key under which a fingerprint can be met."""
    seg = _segments(fps)
    index = [golay.decode(s) for s in seg]
    near = [golay.nearby(s) for s in seg]
    rows, keys = [], []
    for i in range(3):
        for j in range(3):
            if i == j:
                continue
            row, idx = near[j]
            rows.append(row)
            keys.append((3 * i + j) << 40 | seg[i][row] << 12 | idx)
            # i decoded, j nearby: with the roles exchanged this is the pair's
            # other half; both halves use the pair's own key space.
            k = 3 - i - j
            lo, hi = min(i, j), max(i, j)
            pair = index[i][row] << 12 | idx if i < j else idx << 12 | index[i][row]
            again = (idx == index[j][row]) & (i > j)  # the half i < j has it already
            for part in range(3):
                value = (seg[k][row] >> 7 * part) & (0x7F if part < 2 else 0xFF)
                rows.append(row[~again])
                keys.append(((9 + 3 * (lo + hi - 1) + part) << 40 | pair << 8 | value)[~again])
    return np.concatenate(rows), np.concatenate(keys)


def bucket_links(fps: np.ndarray, labels: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the groups (labels) of one key's fingerprints as far as
    bit distances allow: a spanning forest, not all pairs.

    A growing group is compared with what is still apart from it, so that a
    dense key costs little more than its size.
    """
    links: list[tuple[int, int]] = []
    names, group, sizes = np.unique(labels, return_inverse=True, return_counts=True)
    by_group = np.argsort(group, kind="stable")
    first = np.cumsum(sizes) - sizes
    apart = np.ones(len(names), bool)
    for seed in np.argsort(-sizes):
        queue = [seed] if apart[seed] else []
        apart[seed] = False
        while queue:
            g = queue.pop()
            members = fps[by_group[first[g]:first[g] + sizes[g]]]
            for a in range(0, len(members), 256):
                rest = np.flatnonzero(apart[group])
                if not len(rest):
                    return links
                for b in range(0, len(rest), 1 << 14):
                    part = rest[b:b + (1 << 14)]
                    apart_bits = differing_bits(members[a:a + 256, None], fps[part][None, :])
                    for met in np.unique(group[part[(apart_bits <= max_bits).any(axis=0)]]):
                        if apart[met]:
                            links.append((int(names[g]), int(names[met])))
                            queue.append(met)
                            apart[met] = False
    return links


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return start, np.diff(np.append(start, len(keys)))


def sorted_links(keys: np.ndarray, fps: np.ndarray, labels: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between labels within runs of equal keys."""
    found = []
    start, size = _runs(keys)
    small = size <= 32
    inside = np.repeat(small, size)
    for d in range(1, int(size[small].max(initial=1))):
        a = np.flatnonzero((keys[:-d] == keys[d:]) & inside[:-d] & (labels[:-d] != labels[d:]))
        if len(a):
            a = a[differing_bits(fps[a], fps[a + d]) <= max_bits]
            found.append((labels[a], labels[a + d]))
    for s, n in zip(start[~small], size[~small], strict=True):
        pairs = bucket_links(fps[s:s + n], labels[s:s + n], max_bits)
        if pairs:
            found.append(tuple(np.array(pairs, np.int64).T))
    return found


_LINK = "a long, b long, key long, block long"


def _links_of_buckets(buckets: DataFrame, max_bits: int, block: int) -> DataFrame:
    """Links (a, b) from rows (key, fp, label) sorted by key within partitions;
    rows of a key with more than ``block`` fingerprints come back as (fp,
    label, key, block) instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        held = [empty, empty, empty]
        hot_key, hot_rows = None, 0

        def out(a, b, key=None, blocks=None):
            none = pa.nulls(len(a), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), none if key is None else pa.array(key),
                 none if key is None else pa.array(blocks)], names=["a", "b", "key", "block"])

        for batch in batches:
            cols = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            keys = cols[0]
            if not len(keys):
                continue
            if hot_key is not None:
                n = int(np.searchsorted(keys != hot_key, True)) if keys[0] == hot_key else 0
                if n:
                    yield out(cols[1][:n], cols[2][:n], keys[:n], (hot_rows + np.arange(n)) // block)
                    hot_rows += n
                    cols = [c[n:] for c in cols]
                    keys = cols[0]
                if len(keys):
                    hot_key = None
                else:
                    held = cols
                    continue
            last = int(np.flatnonzero(keys == keys[-1])[0])
            for a, b in sorted_links(keys[:last], cols[1][:last], cols[2][:last], max_bits) if last else ():
                yield out(a, b)
            held = [c[last:] for c in cols]
            if len(held[0]) > block:
                hot_key, hot_rows = held[0][0], len(held[0])
                yield out(held[1], held[2], held[0], np.arange(hot_rows) // block)
                held = [empty, empty, empty]
        if len(held[0]):
            for a, b in sorted_links(*held, max_bits):
                yield out(a, b)

    return buckets.mapInArrow(run, _LINK)


def _find_links(nodes: DataFrame, make_keys, max_bits: int, block: int) -> DataFrame:
    """Links (a, b) between the labels of ``nodes`` (fp, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, labels = (c.to_numpy() for c in batch.columns)
            for i in range(0, len(fps), 4096):
                row, key = make_keys(fps[i:i + 4096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(fps[i:i + 4096][row]), pa.array(labels[i:i + 4096][row])],
                    names=["key", "fp", "label"])

    keyed = nodes.select("fp", "label").mapInArrow(run, "key long, fp long, label long")
    found = materialize(_links_of_buckets(
        keyed.repartition("key").sortWithinPartitions("key"), max_bits, block), "simhash-links")
    hot = found.where("key is not null").select("key", "block", F.col("a").alias("fp"), F.col("b").alias("label"))
    blocks = hot.groupBy("key").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), "last"))
    paired = hot.join(blocks, "key").withColumn("other", other).select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp", "label")
    crossed = _links_of_buckets(paired.repartition("key").sortWithinPartitions("key"), max_bits, 2 * block + 1)
    return found.where("key is null").select("a", "b").unionByName(crossed.select("a", "b"))


def components(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(fp, root, component): every distinct fingerprint, the number of its
    component, and that component's smallest doc_id, from rows (doc_id,
    fingerprint)."""
    if max_bits > 4:
        raise ValueError("the Golay keys cover at most 4 differing bits")
    nodes = materialize(prints.groupBy(F.col("fingerprint").alias("fp"))
                        .agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    own = nodes.select("fp", F.col("fp").alias("label"))
    first = connected_components(_find_links(own, centre_keys, max_bits, block), "a", "b")
    grouped = materialize(
        nodes.join(first, nodes["fp"] == first["node"], "left")
        .select("fp", "least_id", F.coalesce("root", "fp").alias("label")), "simhash-groups")
    second = connected_components(_find_links(grouped, all_keys, max_bits, block), "a", "b")
    # Both sides are written: a join on shuffles of its own lets Spark split a large component.
    rooted = materialize(grouped.join(second, grouped["label"] == second["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "label").alias("root")), "simhash-roots")
    least = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component")), "simhash-least")
    return rooted.join(least, "root").select("fp", "root", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", extra: dict | None = None,
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: doc_id, fingerprint (signed), root and component_id of its
    component, and the extra expressions of the row."""
    kept = [F.col(id_col).alias("doc_id")] + [c.alias(n) for n, c in (extra or {}).items()]
    prints = materialize(with_fingerprints(docs, kept, text, shingle), "simhash-prints")
    found = components(prints, max_bits)
    return prints.join(found, prints["fingerprint"] == found["fp"], "left").drop("fp").withColumnRenamed(
        "component", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with its own columns: the one with the
    smallest doc_id (null ids last); of rows equal in doc_id, the one whose
    text has the smallest hash; of rows equal in both, any one.
    """
    text_key = F.coalesce(F.xxhash64(F.col(text)), F.lit(0))
    found = near_duplicates(docs, id_col, text, {"text_key": text_key}, **options)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    keep = found.groupBy("root").agg(F.min(rank).alias("k"))
    zero = F.lit(0).cast("long")
    keep = keep.select(F.coalesce("k.d", zero).alias("k_id"), F.col("k.n").alias("k_null"), F.col("k.t").alias("k_text"))
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), zero).alias("k_id"),
                         F.col(id_col).isNull().alias("k_null"), text_key.alias("k_text"))
    keys = ["k_id", "k_null", "k_text"]
    return packed.join(keep, keys, "left_semi").dropDuplicates(keys).select("row.*")
