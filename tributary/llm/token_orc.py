"""Token ids in ORC: range-ordered stripes with Bloom filters on document ids.

``write_tokens`` orders documents by id over range partitions, encodes each
partition as it streams by, and lets Spark's ORC writer store it: integer
run-length encoding, a row index every ``row_index_stride`` rows, Bloom filters
and min/max statistics on doc_id per stripe.  A row holds the document's ids
and where they start within its shard (= range partition), so readers can take
any stripe alone; the start in the whole corpus is the shard's base, a prefix
sum over one number per shard.

``read_documents`` looks up documents by id: Spark pushes the filter into the
ORC reader, which skips stripes by statistics, Bloom filter and row index.

Encoding: the byte-level tokenizer splits a text into pieces at white space
before merging, so a text in which no two white-space characters meet is the
concatenation of its space- and newline-led units, each encoded once per worker
and remembered; any other text is encoded whole.  Both give the same ids.
A text that holds the string of an added token (``<|endoftext|>``) gets the ids
that the library gives it by default: it is encoded whole, and the string
becomes that token.  With ``special_as_text`` such strings are plain text.

Defined cases: a null or empty text is the end id alone; rows that repeat a
doc_id stay rows of their own, ordered by the hash of the text; null ids come
first; an empty table writes no rows.  Extra columns are not written.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import suffix_arrays as sa
from .textmap import byte_groups, kept_in_worker

END_ID = 2
#: Remembered units per Python worker; when full, those of one group of texts are forgotten.
MEMORY_UNITS = 600_000
ORC_OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
               "orc.row.index.stride": "1000", "orc.stripe.size": str(64 << 20),
               "orc.create.index": "true", "compression": "snappy"}

_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"
_ODD = rf"{_SPACE}{{2}}|\x00"  # such a text is encoded whole


class Encoder:
    """Encodes batches of texts with one tokenizer file."""

    def __init__(self, tokenizer_json: bytes, end_id: int = END_ID, memory_units: int = MEMORY_UNITS,
                 special_as_text: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                 if not (special_as_text and t.special)]
        self.odd = "|".join([_ODD, *map(re.escape, added)])
        self.end_id, self.memory_units = end_id, memory_units
        vocabulary = self.tokenizer.get_vocab()
        # In a byte-level vocabulary each character of an entry is one byte.
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for entry, number in vocabulary.items():
            self.id_bytes[number] = len(entry)
        self._forget()

    def _forget(self) -> None:
        self.number = pa.array([""], pa.string())  # of a unit: its place; "" has no ids
        self.tokens = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)
        self.length = np.zeros(1, np.int64)
        self.groups = np.zeros(1, np.int32)  # of texts that had the unit

    def _forget_rare(self) -> None:
        """Forget the units that only one group of texts had; all, if the rest
        fills more than half of the memory."""
        kept = np.flatnonzero(self.groups[1:] > 1) + 1
        if 2 * len(kept) > self.memory_units:
            return self._forget()
        known = self.number.take(pa.array(np.append(0, kept)))
        tokens, first, length = self.tokens, self.first[kept], self.length[kept]
        self._forget()
        self.number = known
        self.tokens = tokens[sa.spread(first, length)]
        self.first = np.append(0, np.cumsum(length) - length)
        self.length = np.append(0, length)
        self.groups = np.zeros(len(self.length), np.int32)

    def _units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The unit numbers of all texts one after another, and how many each
        text has.  Arrow cuts the texts and folds equal units behind the known
        ones, which so keep their numbers; new units follow and are encoded."""
        marked = pc.replace_substring(texts, " ", "\x00 ")
        marked = pc.replace_substring(marked, "\n", "\x00\n\x00")
        lists = pc.split_pattern(marked, "\x00")
        n_known = len(self.number)
        units = pa.concat_arrays([self.number, lists.flatten()]).dictionary_encode()
        number = units.indices.to_numpy()[n_known:]
        if len(units.dictionary) > n_known:
            self._learn(units.dictionary.slice(n_known))
            self.number = units.dictionary
        self.groups += np.bincount(number, minlength=len(self.groups)) > 0
        return number, pc.list_value_length(lists).to_numpy()

    def _encode_plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units one after another, and the ids of each.

        Units that start with a space and end in none are encoded a hundred at
        a time: the pieces of such a run are those of its units, and the bytes
        that each id stands for tell where one unit's ids end.
        """
        if not len(units):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ends = np.frombuffer(units.buffers()[1], np.int32)[units.offset:][:len(units) + 1]  # one after another in one buffer
        content, cuts = memoryview(units.buffers()[2] or b""), np.append(ends[:-1:100], ends[-1]).tolist()
        encoded = self._encode_plain([str(content[a:b], "utf-8") for a, b in zip(cuts, cuts[1:], strict=False)])
        ids = np.fromiter(chain.from_iterable(encoded), np.int32, sum(map(len, encoded)))
        reached = np.cumsum(self.id_bytes[ids])
        last = np.searchsorted(reached, ends[1:] - ends[0])
        if not np.array_equal(reached[last], ends[1:] - ends[0]):
            raise ValueError("the tokenizer merges over a space")
        return ids, np.diff(np.append(-1, last))

    def _learn(self, new: pa.Array) -> None:
        """Encode units that just got the next numbers."""
        joins = pc.starts_with(new, " ").to_numpy(zero_copy_only=False)
        joins &= pc.equal(pc.binary_length(pc.utf8_rtrim_whitespace(new)), pc.binary_length(new)).to_numpy(zero_copy_only=False)
        ids, length = self._encode_units(new.filter(pa.array(joins)))
        alone = self._encode_plain(new.filter(pa.array(~joins)).to_pylist())
        lengths = np.empty(len(new), np.int64)
        lengths[joins] = length
        lengths[~joins] = np.fromiter(map(len, alone), np.int64, len(alone))
        first = np.empty(len(new), np.int64)
        first[joins] = np.cumsum(length) - length
        first[~joins] = len(ids) + np.cumsum(lengths[~joins]) - lengths[~joins]
        self.first = np.concatenate([self.first, len(self.tokens) + first])
        self.length = np.concatenate([self.length, lengths])
        self.groups = np.concatenate([self.groups, np.zeros(len(new), np.int32)])
        self.tokens = np.concatenate([self.tokens, ids, np.fromiter(chain.from_iterable(alone), np.int32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text, each
        with the end id."""
        if len(self.number) > self.memory_units:
            self._forget_rare()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        number, per_text = self._units(pc.if_else(odd, "", texts) if whole else texts)
        length = self.length[number]
        ids = self.tokens[sa.spread(self.first[number], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum(per_text)]
        n_ids = np.diff(np.concatenate([[0], ends]))
        if not whole:
            sizes = n_ids + 1
            return np.insert(ids, ends, self.end_id), sizes
        encoded = dict(zip(whole, self._encode_plain(texts.take(pa.array(whole)).to_pylist()), strict=True))
        pieces, sizes = [], np.empty(len(texts), np.int64)
        end = np.array([self.end_id], np.int32)
        for i, (at, n) in enumerate(zip(ends - n_ids, n_ids, strict=True)):
            own = np.array(encoded[i], np.int32) if i in encoded else ids[at:at + n]
            sizes[i] = len(own) + 1
            pieces += (own, end)
        return np.concatenate(pieces), sizes


def _encode_shards(ordered: DataFrame, tokenizer_json, name: str, end_id: int, memory_units: int,
                   group_bytes: int, special_as_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = TaskContext.get().partitionId(), 0
        with kept_in_worker(f"encoder {name} {end_id} {memory_units} {special_as_text}",
                            lambda: Encoder(tokenizer_json.value, end_id, memory_units, special_as_text)) as encoder:
            for batch in batches:
                texts = batch.column("text")
                for a, b in byte_groups(texts, group_bytes):
                    ids, sizes = encoder.encode(texts.slice(a, b - a))
                    ends = np.cumsum(sizes)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(a, b - a), pa.array(np.full(b - a, shard, np.int32)),
                         pa.array(at + ends - sizes), pa.array(sizes),
                         pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))],
                        names=["doc_id", "shard", "shard_start", "n_tokens", "ids"])
                    at += int(ends[-1])

    return ordered.select("doc_id", "text").mapInArrow(
        run, "doc_id long, shard int, shard_start long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID,
                 id_col: str = "doc_id", text: str = "text", shards: int | None = None,
                 memory_units: int = MEMORY_UNITS, group_bytes: int = 6 << 20,
                 special_as_text: bool = False) -> None:
    """Write the ids of all documents as ORC under ``path``, ordered by doc_id
    over the shards; equal ids are spread by the text's hash.  Fewer remembered
    units and smaller groups of texts take less memory and more time."""
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as f:
        tokenizer_json = spark.sparkContext.broadcast(f.read())  # one tokenizer file, a few MB
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    _encode_shards(ordered, tokenizer_json, tokenizer_file, end_id, memory_units, group_bytes, special_as_text).write.mode("overwrite").options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (in the whole corpus), n_tokens, ids of every document.

    The shard bases are a prefix sum over one row per shard, read from two
    narrow columns; they are as many as the write had tasks.
    """
    stored = spark.read.orc(path)
    sizes = stored.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(_before_shard())
    bases = sizes.select("shard", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    return stored.join(F.broadcast(bases), "shard").select(  # one row per task of the write
"doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids")


def _before_shard():
    from pyspark.sql import Window
    return Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored rows of a few documents; other stripes are skipped."""
    return spark.read.orc(path).where(F.col("doc_id").isin(doc_ids))


def with_crc32(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and ``ids_crc32``: the CRC-32 of a document's ids as
    little-endian unsigned 32-bit integers."""
    types = {f.name: f.dataType.simpleString() for f in tokens.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(crc, pa.int64())],
                                             names=[*keep, "ids_crc32"])

    schema = ", ".join(f"`{k}` {types[k]}" for k in keep) + ", ids_crc32 long"
    return tokens.select(*keep, "ids").mapInArrow(run, schema)
