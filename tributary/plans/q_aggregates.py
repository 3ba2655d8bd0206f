"""Aggregation, co-group and arg-min queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators import cogroup as C
from ..operators import sketches as SK
from ..operators import transforms as X
from ..session import scratch_path, unique_name
from ..sinks import writers as W
from ..sources.files import sql_source
from .registry import query, table

# ---------------------------------------------------------------- A12 minimum slice


def trades(spark, sf_dir):
    """lineitem as the trading feed of the SQL job: Symbol = part, side from the
    return flag, quantity as text with thousands commas (``"2,300"``)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("Symbol"),
        F.when(F.col("l_returnflag") == "N", "Buy").otherwise("Sell").alias("BuyOrSell"),
        F.format_number(F.col("l_quantity") * 100, 0).alias("QuantityTraded"))


@query("signed_quantity_sum", ids=("R10", "P16", "P17", "A12"), headline=True, sql="""
select l_partkey as Symbol,
       cast(sum(case when l_returnflag = 'N' then 1 else -1 end * cast(l_quantity * 100 as bigint)) as bigint) as QuantityTraded
from lineitem group by l_partkey
""")
def signed_quantity_sum(spark, sf_dir):
    t = trades(spark, sf_dir)
    qty = T.remove_literal("QuantityTraded", ",").try_cast("bigint")
    return (t.select("Symbol", X.signed_value("BuyOrSell", qty).alias("q"))
             .groupBy("Symbol").agg(F.sum("q").alias("QuantityTraded")))


# ---------------------------------------------------------------- A8 + J2 + J3


def employees(spark, sf_dir):
    """orders as the employee file: emp_id = order key, depart = customer,
    join_date as ``yyyy-MM-dd`` text; low-priority pending orders carry an
    unparseable date, so the invalid-date path is exercised."""
    o = table(spark, sf_dir, "orders")
    bad = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return o.select(
        F.col("o_orderkey").cast("string").alias("emp_id"),
        F.col("o_custkey").alias("depart"),
        F.when(bad, F.lit("2020-13-45")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd")).alias("join_date"),
        F.col("o_orderkey").alias("emp_key"))


@query("dept_count_first", ids=("A8", "J2", "J3", "R14", "A6"), headline=True, sql="""
with e as (
  select cast(o_orderkey as varchar) as emp_id, o_custkey as depart, o_orderkey as emp_key,
         case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then '2020-13-45'
              else strftime(o_orderdate, '%Y-%m-%d') end as join_date
  from orders),
p as (select *, try_strptime(join_date, '%Y-%m-%d') as jd from e),
r as (select *, count(*) over (partition by depart) as n,
             row_number() over (partition by depart order by jd asc nulls last, emp_key) as rn
      from p)
select depart, cast(n as bigint) as emp_count_depart, emp_id,
       strftime(jd, '%Y-%m-%dT%H:%M:%S') as join_date
from r where rn = 1
""")
def dept_count_first(spark, sf_dir):
    """Count and first joiner per department in one aggregate (one shuffle).
    The arg-min is ``min(struct(null flag, date, id))``: exact and
    deterministic on ties, planned as a spillable sort-based partial + final
    aggregate.  The struct carries only fixed-width fields; the emp_id text is
    the id's string form and is derived afterwards."""
    e = employees(spark, sf_dir).withColumn("jd", T.parse_date("join_date"))
    agg = C.named_aggregates(
        e, "depart",
        emp_count_depart=F.count(F.lit(1)),
        first=A.first_by(["jd", "emp_key"], []))
    return agg.select(
        "depart", "emp_count_depart",
        F.coalesce(F.col("first.__o1").cast("string"), F.lit("")).alias("emp_id"),
        T.iso_datetime(F.col("first.__o0").cast("timestamp_ntz")).alias("join_date"))


# ---------------------------------------------------------------- A1 GroupByKey


@query("group_by_key", ids=("A1",), headline=True, sql="""
select l_orderkey, l_suppkey, count(*) as n from lineitem group by all
""")
def group_by_key(spark, sf_dir):
    """Group content as (key, value, multiplicity): one shape at any size."""
    return A.group_by_key(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("group_rows", ids=("A1",), sql="""
select o_custkey, o_orderkey, count(*) over (partition by o_custkey) as n_in_group from orders
""")
def group_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return A.group_rows(o, "o_custkey", "o_orderkey")


# ---------------------------------------------------------------- A2, A3


@query("combine_per_key_sum", ids=("A2",), headline=True, sql="""
select l_partkey, sum(l_quantity) as total from lineitem group by l_partkey
""")
def combine_per_key_sum(spark, sf_dir):
    return A.combine_per_key_sum(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity")


@query("combine_globally_concat", ids=("A3",), sql="""
select vec_id, cast(generate_subscripts(embedding, 1) - 1 as integer) as pos,
       unnest(embedding) as item
from embeddings
""")
def combine_globally_concat(spark, sf_dir):
    """Concatenation of every embedding list in ``vec_id`` order, as rows:
    the global list is ``ORDER BY vec_id, pos`` and never sits in one row."""
    return A.concat_lists_rows(table(spark, sf_dir, "embeddings"), ["vec_id"], "embedding")


# ---------------------------------------------------------------- A4-A7, A9


@query("count_globally", ids=("A4",), sql="select count(*) as n from orders")
def count_globally(spark, sf_dir):
    return A.count_globally(table(spark, sf_dir, "orders"))


@query("count_no_defaults", ids=("A4",), sql="""
select 'all' as part, count(*) as n from orders
union all select 'none, default', count(*) from orders where o_orderkey is null
union all select 'none', count(*) from orders where o_orderkey is null having count(*) > 0
""")
def count_no_defaults(spark, sf_dir):
    """A whole table, and an empty one with and without the default 0."""
    o = table(spark, sf_dir, "orders")
    none = o.filter(F.col("o_orderkey").isNull())
    parts = {"all": A.count_globally(o, without_defaults=True), "none, default": A.count_globally(none),
             "none": A.count_globally(none, without_defaults=True)}
    first, *rest = [df.select(F.lit(name).alias("part"), "n") for name, df in parts.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


@query("count_per_element", ids=("A5",), sql="""
select l_returnflag, l_linestatus, count(*) as n from lineitem group by all
""")
def count_per_element(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    return A.count_per_element(li)


@query("count_per_key", ids=("A6",), sql="""
select o_custkey, count(*) as n from orders group by o_custkey
""")
def count_per_key(spark, sf_dir):
    return A.count_per_key(table(spark, sf_dir, "orders"), "o_custkey")


@query("mean_globally", ids=("A7",), sql="select avg(l_quantity) as mean from lineitem")
def mean_globally(spark, sf_dir):
    return A.mean_globally(table(spark, sf_dir, "lineitem"), "l_quantity")


@query("mean_per_key", ids=("A7",), sql="""
select l_suppkey, avg(l_quantity) as mean from lineitem group by l_suppkey
""")
def mean_per_key(spark, sf_dir):
    return A.mean_per_key(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity")


@query("count_non_null", ids=("A9", "F11"), sql="""
select c_nationkey, count(case when c_acctbal >= 0 then c_acctbal end) as n
from customer group by c_nationkey
""")
def count_non_null(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    c = c.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return A.count_non_null(c, "c_nationkey", "c_acctbal")


# ---------------------------------------------------------------- A10 + P11


@query("emission_shape_agg", ids=("A10", "P11", "P17"), headline=True, sql="""
select cast(year(l_shipdate) as varchar) as Year, l_returnflag as Country,
       cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as total_emission,
       count(distinct cast(l_suppkey as varchar)) as gas_count
from lineitem group by all
""")
def emission_shape_agg(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    raw = li.select(F.year("l_shipdate").cast("string").alias("Year"),
                    F.col("l_returnflag").alias("Country"),
                    F.col("l_suppkey").cast("string").alias("Gas"),
                    F.col("l_extendedprice").cast("string").alias("Emissions (metric tons CO2e)"))
    named = X.rename_column(raw, "Emissions (metric tons CO2e)", "emission_in_ton")
    named = named.withColumn("emission_in_ton", F.col("emission_in_ton").try_cast("decimal(18,2)"))
    out = A.sum_and_distinct(named, ["Year", "Country"], "emission_in_ton", "Gas",
                             sum_out="total_emission", distinct_out="gas_count")
    return out.withColumn("total_emission", F.col("total_emission").cast("double"))


def _emission_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.year("l_shipdate").cast("string").alias("Year"),
                     F.col("l_returnflag").alias("Country"),
                     F.col("l_suppkey").cast("string").alias("Gas"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("emission_in_ton"))


def emission_estimates(named):
    """A10 with ``approx_count_distinct`` (HyperLogLog++): the estimate, a
    fixed-size sketch per group and one exchange."""
    return A.sum_and_distinct(named, ["Year", "Country"], "emission_in_ton", "Gas", sum_out="total_emission",
                              distinct_out="gas_count", approximate=True, rsd=EMISSION_RSD)


#: Standard error of the estimates, a fifth of what they are held to.
EMISSION_RSD = 0.01


@query("emission_shape_agg_approx", ids=("A10",), sql="""
select cast(year(l_shipdate) as varchar) as Year, l_returnflag as Country,
       cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as total_emission,
       true as gas_count_close
from lineitem group by all
""")
def emission_shape_agg_approx(spark, sf_dir):
    """A10's estimates held against the exact count: within 5 % (one at least)."""
    named = _emission_rows(spark, sf_dir)
    near = emission_estimates(named)
    exact = named.groupBy(F.col("Year").alias("y"), F.col("Country").alias("c")).agg(F.count_distinct("Gas").alias("exact"))
    off = F.abs(F.col("gas_count") - F.col("exact"))
    return near.join(exact, F.col("Year").eqNullSafe(F.col("y")) & F.col("Country").eqNullSafe(F.col("c"))).select(
        "Year", "Country", F.col("total_emission").cast("double").alias("total_emission"),
        (off <= F.greatest(0.05 * F.col("exact"), F.lit(1))).alias("gas_count_close"))


@query("distinct_sketches", ids=("A10",))
def distinct_sketches(spark, sf_dir):
    """Monthly sketches are stored; years and the whole are merged from them
    without reading the rows again: (level, year, rows, estimate)."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    stored = SK.store_sketches(orders, ["month"], "o_custkey", scratch_path(spark, "customer-sketches"))
    by_year = SK.merge_sketches(stored.withColumn("year", F.year("month")), ["year"])
    whole = SK.merge_sketches(stored, [])
    return (by_year.select(F.lit("year").alias("level"), "year", "n_rows", "estimate")
            .unionByName(whole.select(F.lit("all").alias("level"), F.lit(None).cast("int").alias("year"), "n_rows", "estimate")))


# ---------------------------------------------------------------- A11 + P16 + F12


@query("conditional_pivot", ids=("A11", "P16", "F12"), sql="""
select o_orderpriority,
  cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) else 0 end) as decimal(18,2)) as status_f,
  cast(sum(case when o_orderstatus = 'O' then cast(o_totalprice as decimal(18,2)) else 0 end) as decimal(18,2)) as status_o,
  cast(sum(case when o_orderstatus = 'P' then cast(o_totalprice as decimal(18,2)) else 0 end) as decimal(18,2)) as status_p
from orders group by o_orderpriority
""")
def conditional_pivot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn(
        "amount", F.col("o_totalprice").cast("decimal(18,2)"))
    cases = {f"status_{s.lower()}": F.col("o_orderstatus") == s for s in ("F", "O", "P")}
    out = A.conditional_sums(o, "o_orderpriority", "amount", cases)
    return out.select("o_orderpriority",
                      *[F.col(c).cast("decimal(18,2)").alias(c) for c in cases])


# ---------------------------------------------------------------- A14, A15, A16


@query("sql_max_by_ordinal", ids=("A14", "K9", "S12"), sql="""
select o_custkey, max(o_totalprice) as max_total from orders group by 1
""")
def sql_max_by_ordinal(spark, sf_dir):
    """The SQL job: an ordinal GROUP BY, its result written to a table (an
    external table under the shared folder), then read back by name."""
    result = sql_source(spark, "select o_custkey, max(o_totalprice) as max_total from {orders} group by 1",
                        orders=table(spark, sf_dir, "orders"))
    return W.replace_table_as_select(result, unique_name("max_by_customer"))


@query("distinct_rows", ids=("A16",), sql="select distinct p_brand, p_type from part")
def distinct_rows(spark, sf_dir):
    return A.distinct_rows(table(spark, sf_dir, "part").select("p_brand", "p_type"))


@query("array_distinct_values", ids=("A16",), sql="""
select p_partkey, list_sort(list_distinct(string_split(p_name, ' '))) as words from part
""")
def array_distinct_values(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey",
                    F.array_sort(F.array_distinct(T.split_on("p_name", " "))).alias("words"))


# ---------------------------------------------------------------- J1, J2


@query("cogroup", ids=("J1",), headline=True, sql="""
select c_nationkey as nationkey, 'left' as side, c_name as value, count(*) as n from customer group by all
union all
select s_nationkey, 'right', s_name, count(*) from supplier group by all
""")
def cogroup(spark, sf_dir):
    """Customer and supplier names of every nation, as (key, side, value,
    multiplicity) rows."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    return C.cogroup(c, s, "nationkey", "c_name", "s_name")


@query("cogroup_rows", ids=("J1",), sql="""
select c_nationkey as nationkey, 'left' as side, c_name as value from customer
union all
select s_nationkey, 'right', s_name from supplier
""")
def cogroup_rows(spark, sf_dir):
    """J1 rows form: the co-group as (key, side, value) rows, no list built."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nationkey")
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nationkey")
    return C.cogroup_rows(c, s, "nationkey", "c_name", "s_name")


@query("named_cogroup", ids=("J2",), sql="""
with a as (select o_orderkey as k, count(*) as n_orders from orders group by 1),
     b as (select l_orderkey as k, cast(sum(l_quantity) as double) as qty from lineitem group by 1)
select coalesce(a.k, b.k) as k, a.n_orders, b.qty from a full outer join b on a.k = b.k
""")
def named_cogroup(spark, sf_dir):
    a = (table(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("k"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    b = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
         .agg(F.sum("l_quantity").alias("qty")))
    return C.full_outer_by_key(a, b, "k")
