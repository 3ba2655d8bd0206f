"""Whole jobs (``tributary.jobs``) over files written from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import jobs
from ..session import scratch_path, unique_name
from ..sinks import writers as W
from ..streaming import streams as ST
from .q_aggregates import employees, trades
from .q_io import _PLAYER_ROWS_SQL, PLAYER_DDL, _player_docs
from .q_streams import _json_messages
from .registry import query, table


@query("job_department_first_join", ids=("A8", "J2", "J3", "S4", "K8"), sql="""
with e as (
  select cast(o_orderkey as varchar) as emp_id, o_custkey as depart, o_orderkey as k,
         try_strptime(case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then '2020-13-45'
                           else strftime(o_orderdate, '%Y-%m-%d') end, '%Y-%m-%d') as jd
  from orders),
r as (select *, count(*) over (partition by depart) as n,
             row_number() over (partition by depart order by jd asc nulls last, k) as rn from e)
select cast(depart as varchar) as depart, n as emp_count_depart, emp_id,
       strftime(jd, '%Y-%m-%dT%H:%M:%S') as join_date from r where rn = 1
""")
def job_department_first_join(spark, sf_dir):
    path = scratch_path(spark, "employees_csv")
    e = employees(spark, sf_dir).select("emp_id", F.concat(F.lit("name "), "emp_id").alias("name"), "depart", "join_date")
    e.write.option("header", True).csv(path)
    return jobs.department_first_join(spark, path, scratch_path(spark, "departments_json"))


@query("job_emissions_summary", ids=("K5", "A10", "S7"), sql="""
select cast(year(l_shipdate) as varchar) as Year, l_returnflag as Country,
       sum(l_quantity) as total_emission, count(distinct l_suppkey) as gas_count
from lineitem group by all
""")
def job_emissions_summary(spark, sf_dir):
    path = scratch_path(spark, "emissions_csv")
    li = table(spark, sf_dir, "lineitem")
    li.select(F.year("l_shipdate").alias("Year"), F.col("l_returnflag").alias("Country"), F.col("l_suppkey").alias("Gas"),
              F.col("l_quantity").alias("Emissions (metric tons CO2e)")).write.option("header", True).csv(path)
    return jobs.emissions_summary(spark, path, scratch_path(spark, "emissions"))


@query("job_clean_csv_ingest", ids=("S15", "S8", "P12", "P13", "P14", "P15"), sql="""
select c_custkey as cust_key, c_name as full_name, cast(cast(c_acctbal as decimal(18,2)) as double) as account_balance,
       timestamp '2024-03-01 12:30:00' as processed_timestamp
from customer
""")
def job_clean_csv_ingest(spark, sf_dir):
    """Dirty files land, are cleaned once, and leave the landing folder."""
    landing = scratch_path(spark, "dirty_csv")
    c = table(spark, sf_dir, "customer")
    amount = F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    c.select(F.col("c_custkey").alias("cust key"), F.col("c_name").alias("full-name"),
             amount.alias("account balance"), F.lit("x").alias("Unnamed: 3")).write.option(
        "header", True).option("sep", ";").csv(landing)
    out = jobs.clean_csv_ingest(spark, landing, scratch_path(spark, "clean"), scratch_path(spark, "clean_ckpt"),
                                remove_source=True, processed_at=F.to_timestamp_ntz(F.lit("2024-03-01 12:30:00")))
    if not ST.files_in(spark, landing).isEmpty():
        raise RuntimeError("ingested files are still in the landing folder")
    return out.drop("batch_id")


@query("job_player_totals", ids=("S10", "P5", "F2", "A13", "R17", "K2"), sql=_PLAYER_ROWS_SQL + """
select player_name as playername, cast(max(prev) as double[]) as best_previous3innings,
       cast(sum(runs) as bigint) as total_run, cast(sum(wickets) as bigint) as total_wickets
from p where overs <> 0 group by 1
""")
def job_player_totals(spark, sf_dir):
    path = scratch_path(spark, "players_json")
    W.write_json_arrays(_player_docs(spark, sf_dir), path)
    return jobs.player_totals(spark, path, scratch_path(spark, "player_totals"), PLAYER_DDL)


@query("job_trading_net_quantity", ids=("S4", "S5", "A12", "K1", "R10"), sql="""
select cast(l_partkey as varchar) as symbol,
       cast(sum(case when l_returnflag = 'N' then 1 else -1 end * cast(l_quantity * 100 as bigint)) as bigint) as net
from lineitem group by 1
""")
def job_trading_net_quantity(spark, sf_dir):
    """The trading feed as CSV, quantities with thousands commas, net per symbol."""
    path = scratch_path(spark, "trades_csv")
    feed = trades(spark, sf_dir)
    feed = feed.select(*[(F.col(c) if c in feed.columns else F.lit("")).cast("string").alias(c) for c in jobs.TRADING_FIELDS])
    feed.write.option("header", True).csv(path)
    out = jobs.trading_net_quantity(spark, path, scratch_path(spark, "net_quantity"))
    return out.select(F.col(out.columns[0]).alias("symbol"), F.col(out.columns[1]).cast("long").alias("net"))


@query("job_selected_word_counts", ids=("S3", "P2", "F3", "A5"), sql="""
select word, count(*) as n from (select unnest(string_split(p_name, ' ')) as word from part)
where word in ('red', 'blue', 'green', 'steel', 'small', 'large') group by 1
""")
def job_selected_word_counts(spark, sf_dir):
    path = scratch_path(spark, "part_names")
    table(spark, sf_dir, "part").select("p_name").write.text(path)
    out = jobs.selected_word_counts(spark, path, ["red", "blue", "green", "steel", "small", "large"])
    return out.select(F.col(out.columns[0]).alias("word"), F.col(out.columns[1]).alias("n"))


@query("job_json_messages_stream", ids=("S13", "T8", "P6", "R16", "K1"), sql="""
select strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as timestamp, props as data from events where event_type <> 'error'
""")
def job_json_messages_stream(spark, sf_dir):
    topic = scratch_path(spark, "messages_topic")
    _json_messages(spark, sf_dir).select("value").write.parquet(topic)
    out, rejects, ckpt = (scratch_path(spark, f"messages_{x}") for x in ("out", "rejects", "ckpt"))
    return jobs.json_messages_stream(spark, topic, out, rejects, ckpt)


@query("job_country_counts", ids=("S6", "A9", "K6"), sql="""
select n_name as DEST_COUNTRY_NAME, count(case when c_acctbal >= 0 then c_name end) as n
from customer join nation on c_nationkey = n_nationkey group by 1
""")
def job_country_counts(spark, sf_dir):
    """Customers as flights to their nation, the origin missing where the balance is negative."""
    path, out = scratch_path(spark, "flights_csv"), scratch_path(spark, "flight_counts")
    flights = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    flights.select(F.col("n_name").alias("DEST_COUNTRY_NAME"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("ORIGIN_COUNTRY_NAME"),
                   F.lit(1).alias("count")).write.option("header", True).csv(path)
    jobs.country_counts(spark, path, out)
    stored = spark.read.csv(out, header=True, schema="DEST_COUNTRY_NAME string, n long")
    return stored


@query("job_news_lines", ids=("P4", "F3", "F5", "F6", "F7", "R22"), sql=r"""
with l as (select unnest(string_split(text, chr(10))) as line from documents),
     s as (select trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as line from l)
select line, count(*) as n from s
where line <> '' and line not in ('Home', 'Menu') and not regexp_matches(line, '^[0-9]+ (hours|hour) ago$') group by 1
""")
def job_news_lines(spark, sf_dir):
    lines = jobs.news_lines(table(spark, sf_dir, "documents").select("text"), "text", ["Home", "Menu"])
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("job_top_rentals", ids=("L1", "F9", "S11"), sql="""
select distinct user_id as rental_id, ts as start_date from events where cast(ts as date) = date '2024-01-15'
order by start_date, rental_id limit 100
""")
def job_top_rentals(spark, sf_dir):
    rentals = table(spark, sf_dir, "events").select(F.col("user_id").alias("rental_id"), F.col("ts").alias("start_date"))
    return jobs.distinct_top_rentals(spark, rentals, "2024-01-15")


@query("job_load_then_summarize", ids=("S9", "K3", "K4", "A15"), sql="""
select 'P' || l_partkey as Symbol, case when l_returnflag = 'N' then 'Buy' else 'Sell' end as BuyOrSell,
       cast(sum(l_linenumber) as bigint) as total_count
from lineitem group by all
""")
def job_load_then_summarize(spark, sf_dir):
    path = scratch_path(spark, "load_csv")
    table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("Symbol"), F.when(F.col("l_returnflag") == "N", "Buy").otherwise("Sell").alias("BuyOrSell"),
        F.col("l_linenumber").alias("QuantityTraded")).write.option("header", True).csv(path)
    return jobs.load_then_summarize(spark, path, scratch_path(spark, "load_stage"), unique_name("job_summary"),
                                    scratch_path(spark, "load_summary"))


@query("job_sql_to_table", ids=("K9", "A14", "S12"), sql="""
select c_nationkey, max(c_acctbal) as highest from customer group by 1
""")
def job_sql_to_table(spark, sf_dir):
    return jobs.sql_to_table(spark, "select c_nationkey, max(c_acctbal) as highest from {customer} group by 1",
                             unique_name("job_sql"), scratch_path(spark, "job_sql"), customer=table(spark, sf_dir, "customer"))
