"""Hooks for user code.

Built-in operators never use Python UDFs; these hooks exist for functions a
user brings.  All of them move data as Arrow batches (pandas), never row by
row, and none gathers a whole group in one task:

* ``map_hook``       X1  scalar ``pandas_udf``
* ``flat_map_hook``  X2  ``mapInPandas``: a row -> n rows function
* ``combine_hook``   X3  a combiner lifted into partial + final steps
* ``ordered_combine_hook`` A3/X3  a combiner whose merge does not commute
* ``transform``      X4  ``DataFrame.transform`` for composite transforms
* X5 is ``transforms.with_branch`` (a branch-number column) and ``transforms.partition``
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .ordered import in_order, row_numbers

# The batch functions below run in Python workers on the executors, which do
# not have this package installed: ship them by value, not by module path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Accumulator types of ``combine_hook``.
ARROW_TYPES = {"double": pa.float64(), "float": pa.float32(), "bigint": pa.int64(), "int": pa.int32(),
               "string": pa.string(), "boolean": pa.bool_()}


def map_hook(fn: Callable[[pd.Series], pd.Series], return_type: str) -> Callable[..., Column]:
    """Wrap a vectorised ``Series -> Series`` function as a column function."""
    return F.pandas_udf(fn, return_type)


def flat_map_hook(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """``fn(row_dict)`` yields any number of output dicts (a ``DoFn``), for
    functions that think in rows; ``flat_map_batches`` is the form for speed."""
    fields = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [o for rec in pdf.to_dict("records") for o in fn(rec)]
            yield pd.DataFrame(out, columns=fields)

    return df.mapInPandas(run, schema)


def flat_map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """X2 over Arrow batches: ``fn`` turns one batch into one of any length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)


def combine_hook(df: DataFrame, key: str, value: str,
                 partial: Callable[[pd.Series], float] | str,
                 merge: Callable[[pd.Series], float] | str,
                 out: str = "combined", acc_type: str = "double") -> DataFrame:
    """A user combiner applied per key with combiner lifting.

    ``partial`` reduces the values of one key inside one Arrow batch to an
    accumulator; only accumulators cross the shuffle, and ``merge`` reduces a
    key's accumulators to the result.  A hot key therefore sends one small
    row per batch, never its raw rows, into the final step.  ``merge`` must be
    associative and commutative (as a combiner's merge is).  Either step may
    be a pandas reduction name (``"sum"``, ``"max"``...) to stay vectorised.

    The final step hash-partitions the accumulators by key, sorts within each
    partition, and merges each key's contiguous run; of a key cut by a batch
    boundary only its merged accumulator (one row) goes on to the next batch.
    Keys stay Arrow values throughout, so 64-bit integers are exact and a NULL
    key is a key of its own.
    """
    key_type, acc = df.schema[key].dataType.simpleString(), ARROW_TYPES[acc_type]

    def grouped(keys: pa.Array, values: pa.Array, fn) -> tuple[pa.Array, pa.Array]:
        coded = keys.dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        # Arrow-backed series: integers with NULLs among them stay integers.
        g = values.to_pandas(types_mapper=pd.ArrowDtype).groupby(codes, sort=False).agg(fn)
        own = pa.array([None if c < 0 else c for c in g.index], coded.indices.type)
        return coded.dictionary.take(own), pa.Array.from_pandas(g, type=acc)

    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(list(grouped(batch.column(0), batch.column(1), partial)), names=[key, "__acc"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keys, values = batch.column(0), batch.column(1)
            if held is not None:
                keys, values = (pa.concat_arrays([h, c]) for h, c in zip(held, (keys, values), strict=True))
            if not len(keys):
                continue
            keys, values = grouped(keys, values, merge)   # sorted input: the last key comes last
            held = (keys.slice(len(keys) - 1), values.slice(len(values) - 1))
            if len(keys) > 1:
                yield pa.RecordBatch.from_arrays([keys.slice(0, len(keys) - 1), values.slice(0, len(values) - 1)],
                                                 names=[key, out])
        if held is not None:
            yield pa.RecordBatch.from_arrays(list(held), names=[key, out])

    accs = df.select(key, value).mapInArrow(lift, f"`{key}` {key_type}, __acc {acc_type}")
    return (accs.repartition(key).sortWithinPartitions(key)
                .mapInArrow(finish, f"`{key}` {key_type}, `{out}` {acc_type}"))


class OrderedCombiner(Protocol):
    """A user combiner whose ``merge`` is associative but need not commute:
    ``merge(a, b)`` always gets ``a`` from rows before those of ``b``."""

    def create(self) -> Any: ...
    def add(self, acc: Any, value: Any) -> Any: ...
    def merge(self, a: Any, b: Any) -> Any: ...
    def extract(self, acc: Any) -> Any: ...


#: Accumulators that one step of the merge tree folds.
MERGE_FAN = 16


def ordered_combine_hook(df: DataFrame, value: str, order: Sequence[str], combiner: OrderedCombiner, out_type: str,
                         by: Sequence[str] = (), out: str = "combined") -> DataFrame:
    """Fold ``value`` in the given order, over the table or per group.

    Rows are dealt by ranges of (``by``, ``order``), so a hot group spreads over
    many tasks; each stretch of a range is folded where it lies, and only its
    accumulator goes on.  The accumulators of a group, numbered in order, are
    merged by a tree, ``MERGE_FAN`` neighbours at a time.  Rows that tie keep
    the order of the input; NULL values are added as None, NULL groups are a
    group; an empty table has no groups and no row.
    """
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in by)
    keyed = f"{types}, " if by else ""
    placed = in_order(df.select(*dict.fromkeys([*by, *order, value])), order, by)
    width = len(by)

    def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)],
                                          schema=schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, schema = None, [], None  # now: [keys, first place, last place, accumulator]
        for b in batches:
            schema = schema or pa.schema([*list(b.schema)[:width], pa.field("__at", pa.int64()), pa.field("__acc", pa.binary())])
            columns = [c.to_pylist() for c in b.columns]
            for *keys, v, at in zip(*columns, strict=True):
                # a file's rows come in order; another file or split starts a new stretch
                if now is None or now[0] != keys or at != now[2] + 1:
                    if now:
                        done.append((*now[0], now[1], pickle.dumps(now[3])))
                    now = [keys, at, at, combiner.create()]
                now[2], now[3] = at, combiner.add(now[3], v)
            if len(done) >= 1000:
                yield batch(done, schema)
                done = []
        if now:
            yield batch([*done, (*now[0], now[1], pickle.dumps(now[3]))], schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, None
        for b in batches:
            rows = []
            for *keys, up, acc in zip(*[c.to_pylist() for c in b.columns], strict=True):
                acc = pickle.loads(acc)
                if held is not None and held[0] == (keys, up):
                    held[1] = combiner.merge(held[1], acc)
                    continue
                if held is not None:
                    rows.append((*held[0][0], held[0][1], pickle.dumps(held[1])))
                held = [(keys, up), acc]
            if rows:
                yield batch(rows, b.schema)
            number = b.schema
        if held is not None:
            yield batch([(*held[0][0], held[0][1], pickle.dumps(held[1]))], number)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            results = pa.array([combiner.extract(pickle.loads(x)) for x in b.column(width + 1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:width], results], names=[*by, out])

    accs = placed.select(*by, value, "__at").mapInArrow(fold, f"{keyed}__at long, __acc binary")
    accs = materialize(row_numbers(accs, ["__at"], by=by, out="__up").select(*by, "__up", "__acc"), "ordered-accs")
    most = accs.agg(F.max("__up")).first()[0] or 0
    while most > 1:
        up = accs.withColumn("__n", F.col("__up")).withColumn("__up", F.floor((F.col("__up") - 1) / MERGE_FAN) + 1)
        dealt = up.repartition(*by, "__up").sortWithinPartitions(*by, "__up", "__n")
        accs = materialize(dealt.select(*by, "__up", "__acc").mapInArrow(merge, f"{keyed}__up long, __acc binary"),
                           "ordered-accs")
        most = -(-most // MERGE_FAN)
    return accs.mapInArrow(extract, f"{keyed}`{out}` {out_type}")


def transform(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a composite transform (a function of DataFrames)."""
    return df.transform(fn)
