"""User-function hook queries, each checked against the
built-in operator's SQL."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from ..operators import hooks as H
from ..session import spread

# The user functions below run on executors: ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
from .registry import query, table


def _shout(s):
    return s.str.upper() + "!"


@query("udf_map_hook", ids=("X1",), sql="""
select c_custkey, upper(c_mktsegment) || '!' as loud from customer
""")
def udf_map_hook(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", H.map_hook(_shout, "string")("c_mktsegment").alias("loud"))


def _priority_pieces(row):
    """A user ``DoFn``: one output per ``-``-separated piece of the priority."""
    for i, piece in enumerate(str(row["o_orderpriority"]).split("-")):
        yield {"o_orderkey": row["o_orderkey"], "pos": i, "piece": piece}


@query("udf_flatmap_hook", ids=("X2",), sql="""
select o_orderkey, cast(pos as integer) as pos, piece
from (select o_orderkey, unnest(range(len(p))) as pos, unnest(p) as piece
      from (select o_orderkey, string_split(o_orderpriority, '-') as p from orders))
""")
def udf_flatmap_hook(spark, sf_dir):
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"))
    return H.flat_map_hook(o, _priority_pieces, "o_orderkey bigint, pos int, piece string")


def _pieces_batch(batch):
    """The same ``DoFn`` over one Arrow batch."""
    pieces = pc.split_pattern(batch.column(1), "-")
    parent = pc.list_parent_indices(pieces)
    start = np.repeat(pieces.offsets.to_numpy()[:-1], np.diff(pieces.offsets.to_numpy()))
    pos = pa.array(np.arange(len(parent)) - (start - pieces.offsets[0].as_py()), pa.int32())
    return pa.RecordBatch.from_arrays([batch.column(0).take(parent), pos, pieces.flatten()],
                                      names=["o_orderkey", "pos", "piece"])


@query("udf_flatmap_batches", ids=("X2",), sql="""
select o_orderkey, cast(pos as integer) as pos, piece
from (select o_orderkey, unnest(range(len(p))) as pos, unnest(p) as piece
      from (select o_orderkey, string_split(o_orderpriority, '-') as p from orders))
""")
def udf_flatmap_batches(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return H.flat_map_batches(o, _pieces_batch, "o_orderkey bigint, pos int, piece string")


def _max(s):
    return s.max()


@query("udf_combine_hook", ids=("X3",), headline=True, sql="""
select o_custkey, max(o_totalprice) as combined from orders group by o_custkey
""")
def udf_combine_hook(spark, sf_dir):
    o = spread(table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice"))
    return H.combine_hook(o, "o_custkey", "o_totalprice", _max, _max)
