"""Row numbers, running frames, ordered combiners and the skewed full outer
join (SURVEY P22, W1, W2, A3, X3, J2)."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from ..operators import hooks as H
from ..operators import ordered as O
from ..operators.skew_join import full_outer_skewed
from .registry import query, table

# The user combiners below run on executors: ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@query("row_number_orders", ids=("P22",), sql="""
select o_orderkey, row_number() over (order by o_orderdate desc, o_orderkey) as row_id from orders
""")
def row_number_orders(spark, sf_dir):
    """A row id that is an order: contiguous over the whole table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    numbered = O.row_numbers(orders, [F.desc("o_orderdate"), "o_orderkey"], out="row_id")
    return numbered.select("o_orderkey", "row_id")


@query("row_number_by_flag", ids=("P22",), sql="""
select l_orderkey, l_linenumber, l_returnflag,
       row_number() over (partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber) as row_id
from lineitem
""")
def row_number_by_flag(spark, sf_dir):
    """Three groups hold all rows; each spreads over many tasks."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return O.row_numbers(lines, ["l_shipdate", "l_orderkey", "l_linenumber"], by=["l_returnflag"],
                         out="row_id").drop("l_shipdate")


@query("running_totals", ids=("W1", "P22"), sql="""
with d as (select o_orderkey, o_orderdate,
                  cast(case when o_orderstatus <> 'P' then o_totalprice end as decimal(18, 2)) as price from orders)
select o_orderkey, cast(sum(price) over w as decimal(28, 2)) as total, count(price) over w as n,
       max(price) over w as highest, min(price) over w as lowest,
       cast(sum(price) over w as double) / nullif(count(price) over w, 0) as average
from d window w as (order by o_orderdate, o_orderkey rows unbounded preceding)
""")
def running_totals(spark, sf_dir):
    """Running sum, count, extremes and average of a column with NULLs."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).cast("decimal(18,2)")
    found = O.running(orders.select("o_orderkey", "o_orderdate", price.alias("price")), ["o_orderdate", "o_orderkey"], {
        "total": ("sum", "price"), "n": ("count", "price"), "highest": ("max", "price"), "lowest": ("min", "price"),
        "average": ("avg", "price")})
    return found.select("o_orderkey", F.col("total").cast("decimal(28,2)").alias("total"), "n", "highest", "lowest", "average")


@query("running_by_user", ids=("W1", "W2"), sql="""
select event_id, user_id, cast(sum(cast(value as decimal(18, 2))) over w as decimal(28, 2)) as spent,
       count(*) over w as n_events
from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)
""")
def running_by_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts",
                                                   F.col("value").cast("decimal(18,2)").alias("v"))
    found = O.running(events, ["ts", "event_id"], {"spent": ("sum", "v"), "n_events": ("count", "event_id")}, by=["user_id"])
    return found.select("event_id", "user_id", F.col("spent").cast("decimal(28,2)").alias("spent"), "n_events")


class Concatenate:
    """Lists in order: associative, and ``a + b`` is not ``b + a``."""

    def create(self):
        return []

    def add(self, acc, value):
        acc.append(value)
        return acc

    def merge(self, a, b):
        return a + b

    def extract(self, acc):
        return acc


class Drawdown:
    """The largest fall of a running sum from an earlier height: per stretch its
    sum, its highest and lowest running sum (0 included) and its largest fall."""

    def create(self):
        return 0, 0, 0, 0

    def add(self, acc, value):
        return self.merge(acc, (value, max(value, 0), min(value, 0), max(-value, 0)))

    def merge(self, a, b):
        (s1, high1, low1, fall1), (s2, high2, low2, fall2) = a, b
        return s1 + s2, max(high1, s1 + high2), min(low1, s1 + low2), max(fall1, fall2, high1 - (s1 + low2))

    def extract(self, acc):
        return acc[3]


@query("udf_ordered_concat", ids=("A3", "X3"), sql="""
select o_custkey, list(o_orderpriority order by o_orderdate, o_orderkey) as combined from orders group by 1
""")
def udf_ordered_concat(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return H.ordered_combine_hook(orders, "o_orderpriority", ["o_orderdate", "o_orderkey"], Concatenate(),
                                  "array<string>", by=["o_custkey"])


_DRAWDOWN_SQL = """
with d as (select {keys} ts, event_id, cast(round(case when event_type = 'purchase' then value else -value / 4 end * 100)
                                            as bigint) as v from events),
s as (select *, sum(v) over (partition by {part} order by ts, event_id rows unbounded preceding) as total from d),
h as (select {keys} total, greatest(0, max(total) over (partition by {part} order by ts, event_id
                                                        rows between unbounded preceding and 1 preceding)) as high from s)
select {keys} cast(greatest(0, max(coalesce(high, 0) - total)) as bigint) as combined from h {group}
"""


def _drawdown(spark, sf_dir, by):
    change = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(-F.col("value") / 4)
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.round(change * 100).cast("long").alias("v"))
    return H.ordered_combine_hook(events, "v", ["ts", "event_id"], Drawdown(), "long", by=by)


@query("udf_ordered_drawdown", ids=("A3", "X3"), sql=_DRAWDOWN_SQL.format(keys="", part="1", group=""))
def udf_ordered_drawdown(spark, sf_dir):
    """One fold over the whole table, merged as an ordered tree."""
    return _drawdown(spark, sf_dir, [])


@query("udf_ordered_drawdown_user", ids=("A3", "X3"),
       sql=_DRAWDOWN_SQL.format(keys="user_id,", part="user_id", group="group by user_id"))
def udf_ordered_drawdown_user(spark, sf_dir):
    return _drawdown(spark, sf_dir, ["user_id"])


@query("full_outer_skewed", ids=("J2", "J3"), sql="""
select coalesce(user_id, c_custkey) as custkey, event_id, event_type, c_name
from events full outer join customer on user_id = c_custkey
""")
def full_outer_skewed_query(spark, sf_dir):
    """Events and customers: few customers have all the events."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("custkey"), "event_id", "event_type")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return full_outer_skewed(events, customers, "custkey", share=0.006)


@query("full_outer_skewed_nulls", ids=("J2", "J3"), sql="""
with e as (select event_id, case when event_type <> 'view' then event_type end as kind from events),
     t as (select event_type as kind, min(event_id) as first_id from events where event_id % 3 > 0 group by 1
           union all select 'refund', -1 union all select null, -2)
select coalesce(e.kind, t.kind) as kind, event_id, first_id from e full outer join t on e.kind = t.kind
""")
def full_outer_skewed_nulls(spark, sf_dir):
    """Every key is hot and a good part of the keys is NULL."""
    events = table(spark, sf_dir, "events")
    kinds = events.where("event_id % 3 > 0").groupBy(F.col("event_type").alias("kind")).agg(F.min("event_id").alias("first_id"))
    kinds = kinds.unionByName(spark.createDataFrame([("refund", -1), (None, -2)], "kind string, first_id long"))
    kind = F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind")
    return full_outer_skewed(events.select(kind, "event_id"), kinds, "kind")
