"""Benchmark decontamination with suffix arrays over the training texts.

Every task cuts its documents into shards, builds a word-level suffix array
per shard, and binary-searches every suffix of the test items in it.  The
places that share a whole window with a test item are hits; from each the
longest verbatim match is read off the test items' own suffix array.  Nothing
of the corpus is shuffled or collected.

The test items are cut into blocks of about ``BLOCK_BYTES``; tasks index them
and write them to the shared folder.  A task over documents searches a shard
for one block after another: neither the driver nor any task ever holds more
than one block, and a larger benchmark takes more passes over a shard, not
more memory.  (Where there is one block, it travels with the kernel.)  The
shared folder must be one that Arrow's file systems reach.

Defined cases: a null or empty document has no words and is clean; a null or
empty item has no window; an item shorter than the window is one window of
its own length; rows that repeat an item id are one item with all their
windows; an item with a null id is reported as "".  Repeated documents are
judged row by row.  Extra columns pass through untouched.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import suffix_arrays as sa
from .textmap import alnum_words, map_texts

WINDOW = 10
#: Text bytes of a shard: a longer document is a shard of its own.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 2 << 20

_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()),
    T.StructField("longest_word", T.LongType()),
    T.StructField("longest_item", T.StringType()),
    T.StructField("longest_item_word", T.LongType()),
])


class TestSet:
    """One block of test items: words, windows, and their suffix array."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        vocab: dict[bytes, int] = defaultdict(count(1).__next__)
        ids, item_of, word_of = [0], [-1], [-1]
        windows: dict[tuple[int, ...], tuple[int, set[int]]] = {}
        self.depth = window
        for name, text in items:
            words = [vocab[w] for w in alnum_words(text.encode() if text else None)]
            if not words:
                continue
            self.depth = max(self.depth, len(words))
            at, size = len(ids), min(window, len(words))
            for i in range(len(words) - size + 1):
                windows.setdefault(tuple(words[i:i + size]), (at + i, set()))[1].add(number[name])
            ids += words + [0]
            item_of += [number[name]] * len(words) + [-1]
            word_of += list(range(len(words))) + [-1]
        self.vocab = dict(vocab)
        self.ids = np.array(ids, np.int64)
        self.item_of, self.word_of = np.array(item_of), np.array(word_of)
        self.order = sa.build(self.ids, self.depth)
        self.win_at = np.array([at for at, _ in windows.values()], np.int64)
        self.win_len = np.array([len(w) for w in windows], np.int64)
        per_window = [sorted(s) for _, s in windows.values()]
        self.win_items = np.array([i for s in per_window for i in s], np.int64)
        self.win_count = np.array([len(s) for s in per_window], np.int64)
        self.win_first = np.cumsum(self.win_count) - self.win_count


def _lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    """Values sorted by owner as one list per owner 0..n-1."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def search_shard(texts: list[bytes | None], tests: TestSet) -> list[pa.Array]:
    """Hits of one shard of documents, one entry per document."""
    words = [alnum_words(t) for t in texts]
    n = len(words)
    n_words = np.array([len(w) for w in words], np.int64)
    vocab: dict[bytes, int] = defaultdict(count(1).__next__)
    flat = np.fromiter(map(vocab.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
    # Each document is followed by one separator.
    first = np.cumsum(n_words + 1) - (n_words + 1)
    ids = np.zeros(len(flat) + n, np.int64)
    ids[sa.spread(first, n_words)] = flat

    known = np.full(len(tests.vocab) + 1, len(vocab) + 1, np.int64)
    back = np.full(len(vocab) + 1, len(tests.vocab) + 1, np.int64)
    back[0] = 0
    for word, number in tests.vocab.items():
        if word in vocab:
            known[number] = vocab[word]
            back[vocab[word]] = number
    known[0] = 0
    order = sa.build(ids, tests.depth)
    queries = known[tests.ids]
    lo = sa.lower_bound(ids, order, queries, tests.win_at, tests.win_len)
    hi = sa.lower_bound(ids, order, queries, tests.win_at, tests.win_len, after_equal=True)
    found = np.flatnonzero(hi > lo)
    many = hi[found] - lo[found]
    places = order[sa.spread(lo[found], many)]
    window = np.repeat(found, many)

    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + tests.win_len[window], -1)
    hit = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    step = np.diff(hit.astype(np.int8))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    owner = np.searchsorted(first, starts, "right") - 1

    doc = np.searchsorted(first, places, "right") - 1
    pairs = np.unique(doc * max(1, len(tests.win_at)) + window)
    pair_doc, pair_win = np.divmod(pairs, max(1, len(tests.win_at)))
    per = tests.win_count[pair_win]
    items = tests.win_items[sa.spread(tests.win_first[pair_win], per)]
    doc_items = np.unique(np.repeat(pair_doc, per) * max(1, len(tests.names)) + items)
    item_doc, item = np.divmod(doc_items, max(1, len(tests.names)))
    names = pa.array(tests.names, pa.string()).take(pa.array(item))

    at = np.unique(places)
    at_doc = np.searchsorted(first, at, "right") - 1
    room = np.minimum(first[at_doc] + n_words[at_doc] - at, tests.depth) if len(at) else at
    size, where = sa.longest(tests.ids, tests.order, back[ids], at, room)
    best = np.lexsort((at, -size, at_doc))
    best = best[np.unique(at_doc[best], return_index=True)[1]] if len(best) else best
    there = tests.order[where[best]] if len(best) else best
    top = [np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)]
    for column, values in zip(top, (size[best], at[best] - first[at_doc[best]],
                                    tests.item_of[there], tests.word_of[there]), strict=True):
        column[at_doc[best]] = values
    none = top[1] < 0
    return [pa.array(n_words), _lists(owner, pa.array(starts - first[owner]), n),
            _lists(owner, pa.array(ends - first[owner]), n), _lists(item_doc, names, n),
            pa.array(top[0]), pa.array(top[1], mask=none),
            pa.array([tests.names[i] if i >= 0 else None for i in top[2]], pa.string()),
            pa.array(top[3], mask=none)]


def write_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> DataFrame:
    """The items, indexed in blocks of about ``block_bytes`` by a hash of the
    row: (block, data).  Equal rows are one."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                            F.col(text).cast("string").alias("t")).where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // block_bytes) or 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for block, i, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and block != at:
                    yield done(at, held)
                    held = []
                at = block
                held.append((i, t))
        if held:
            yield done(at, held)

    def done(block: int, items: list[tuple[str, str]]) -> pa.RecordBatch:
        data = pickle.dumps(vars(TestSet(sorted(set(items)), window)), protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["block", "data"])

    numbered = rows.select(F.pmod(F.xxhash64("i", "t"), F.lit(n)).cast("int").alias("block"), "i", "t")
    dealt = numbered.repartitionById(n, "block").sortWithinPartitions("block")  # a block is a task and a file
    return materialize(dealt.mapInArrow(index, "block long, data binary"), "test-blocks")


def _restored(data: bytes) -> TestSet:
    tests = TestSet.__new__(TestSet)
    vars(tests).update(pickle.loads(data))
    return tests


def read_block(uri: str) -> list[TestSet]:
    """The block of a file in the shared folder (none, if no item fell there)."""
    where, path = fs.FileSystem.from_uri(uri)
    return [_restored(d) for d in pq.read_table(path, filesystem=where, columns=["data"]).column(0).to_pylist()]


class Found:
    """What a shard's documents share with the blocks searched so far."""

    def __init__(self, texts: list[bytes | None]) -> None:
        self.n = len(texts)
        self.words: pa.Array = pa.array([0] * self.n, pa.int64())
        self.hits = np.zeros(self.n, np.int64)
        self.spans: dict[int, list[tuple[int, int]]] = {}
        self.items: dict[int, set[str]] = {}
        self.best: list[tuple] = [(0, None, None, None)] * self.n

    def add(self, part: list[pa.Array]) -> None:
        self.words, starts, ends, items, *top = part
        for i in np.flatnonzero(np.diff(starts.offsets.to_numpy())).tolist():
            own = self.spans.setdefault(i, [])
            own += zip(starts[i].as_py(), ends[i].as_py(), strict=True)
            self.items.setdefault(i, set()).update(items[i].as_py())
            # the longest match; of equal ones the first, then the item's name and place
            new = tuple(c[i].as_py() for c in top)
            self.best[i] = max(self.best[i], new, key=lambda t: (t[0], -(t[1] or 0), t[2] or "", t[3] or 0))

    def result(self) -> list[pa.Array]:
        for i, own in self.spans.items():
            end = 0
            for a, b in sorted(own):
                self.hits[i] += max(0, b - max(a, end))
                end = max(end, b)
        items = [sorted(self.items.get(i, ())) for i in range(self.n)]
        longest = zip(*self.best, strict=True) if self.n else [[]] * 4
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64())
        return [self.words, pa.array(self.hits), pa.array(items, pa.list_(pa.string())),
                *[pa.array(c, t) for c, t in zip(longest, types, strict=True)]]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` (the kept columns) and ``res`` for every document.

    ``res``: n_words, n_hit (words inside any occurrence of a window), items
    (sorted ids of the items met), and the longest verbatim match: its length
    in words, where it starts, the item, and where it starts there.
    """
    stored = write_blocks(benchmark, item_id, item_text, window, block_bytes)
    files = sorted(stored.inputFiles())
    only = bytes(stored.first().data) if stored.limit(2).count() == 1 else None  # one block travels with the kernel
    if not files or (only is None and stored.isEmpty()):
        only = pickle.dumps(vars(TestSet([], window)))

    def kernel():
        kept = [_restored(only)] if only is not None else None

        def run(texts):
            found = Found(texts)
            if kept:
                found.add(search_shard(texts, kept[0]))
            else:
                for uri in files:
                    for tests in read_block(uri):
                        found.add(search_shard(texts, tests))
            return found.result()
        return run

    size = SHARD_BYTES if only is not None else 4 * SHARD_BYTES
    return map_texts(docs, text, kernel, _RESULT, keep=keep, group_bytes=size)


def contaminated(res: Column) -> Column:
    return res["n_hit"] > 0


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    scanned = scan(docs, benchmark, **options)
    return scanned.where(~contaminated(F.col("res"))).select("row.*")
