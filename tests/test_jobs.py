"""The job-level entry points on small files shaped like the reference jobs'
inputs (FIXTURES.md §2), with hand-computed expected results."""

from __future__ import annotations

import datetime as dt
import json
import os

import fixture_data as D
from tributary import jobs as J
from tributary.session import scratch_path


def _local(path: str) -> str:
    return path.replace("file:", "")


def _write(spark, name: str, text: str, filename: str = "part-0") -> str:
    folder = scratch_path(spark, name)
    os.makedirs(_local(folder), exist_ok=True)
    with open(os.path.join(_local(folder), filename), "w", encoding="utf-8") as f:
        f.write(text)
    return folder


def test_department_first_join(spark):
    csv = _write(spark, "employees", "\n".join([
        "emp_id,name,depart,join_date",
        "10,Ann,IT,2020-01-05", "9,Bob,IT,2020-01-05", "3,Cid,IT,2021-02-01",
        "4,Dee,HR,not-a-date", "5,Eve,HR,2019-12-31", "6,Fay,OPS,bad"]) + "\n", "e.csv")
    out = {r.depart: r for r in J.department_first_join(spark, csv, scratch_path(spark, "dep")).collect()}
    assert (out["IT"].emp_count_depart, out["IT"].emp_id, out["IT"].join_date) == (3, "9", "2020-01-05T00:00:00")
    assert (out["HR"].emp_id, out["HR"].join_date) == ("5", "2019-12-31T00:00:00")
    assert (out["OPS"].emp_id, out["OPS"].join_date) == ("6", None)


def test_trading_net_quantity(spark):
    csv = _write(spark, "trading", "\n".join([
        "Symbol,ByeOrSell,QuantityTraded",
        'AAA,Buy,"1,234"', 'AAA,Sell,"1,000"', "BBB,Sell,7", "BBB,Buy,2"]) + "\n", "t.csv")
    table = scratch_path(spark, "trading_table")
    got = {r.Symbol: r.QuantityTraded for r in J.trading_net_quantity(spark, csv, table).collect()}
    assert got == {"AAA": 234, "BBB": -5}
    J.trading_net_quantity(spark, csv, table)          # append: the table grows
    assert spark.read.parquet(table).count() == 4


def test_selected_word_counts(spark):
    txt = _write(spark, "story", "Kael met Seraphina\nKael  left Eldoria\n", "s.txt")
    got = {r.word: r.n for r in J.selected_word_counts(spark, txt, ["Kael", "Eldoria", "Seraphina"]).collect()}
    assert got == {"Kael": 2, "Eldoria": 1, "Seraphina": 1}


def test_player_totals(spark):
    def match(no, runs, overs, wickets):
        return {"match_no": no, "batting": {"runs": runs}, "bowling": {"overs": overs, "wickets": wickets},
                "fielding": {"catches": 0}}
    players = [
        {"player_name": "P1", "age": 30, "team": "T", "previous_3_batting_avg": [9, 1],
         "performance": [match(1, 10, 4, 2), match(2, 50, 0, 0), match(3, 5, 2, 1)]},
        {"player_name": "P1", "age": 30, "team": "T", "previous_3_batting_avg": [10, 0],
         "performance": [match(4, 1, 1, 1)]},
        {"player_name": "P2", "age": 22, "team": "U", "previous_3_batting_avg": [3, 3],
         "performance": [match(1, 7, 0, 0)]},
    ]
    path = _write(spark, "players", json.dumps(players), "p.json")
    out = {r.playername: r for r in J.player_totals(spark, path).collect()}
    assert set(out) == {"P1"}                              # P2 never bowled
    assert out["P1"].best_previous3innings == [10.0, 0.0]  # element-wise max
    assert (out["P1"].total_run, out["P1"].total_wickets) == (16, 4)


def test_window_counts_stream(spark):
    base = dt.datetime(2024, 1, 1)
    msgs = [f"{i},{(base + dt.timedelta(seconds=s)).strftime('%Y-%m-%d %H:%M:%S.%f')}"
            for i, s in enumerate([0, 1, 4, 5, 11, 200])]
    src = scratch_path(spark, "msgs")
    spark.createDataFrame([(m.encode(),) for m in msgs], "value binary").write.parquet(src)
    out = J.window_counts_stream(spark, src, scratch_path(spark, "wc"), scratch_path(spark, "wc_ck"))
    got = sorted(r.count_window for r in out.collect())
    # The 200 s event sets the watermark to 140 s: its own window stays open.
    assert got == ["1  [2024-01-01 00:00:05 - 2024-01-01 00:00:10]",
                   "1  [2024-01-01 00:00:10 - 2024-01-01 00:00:15]",
                   "3  [2024-01-01 00:00:00 - 2024-01-01 00:00:05]"]


def test_json_messages_stream(spark):
    src = scratch_path(spark, "jmsgs")
    spark.createDataFrame([('{"timestamp": "t1", "data": "a"}',), ('{"timestamp": "t2"',),
                           ('{"timestamp": "t3", "data": "c"}',)], "value string").write.parquet(src)
    rej = scratch_path(spark, "jrej")
    out = J.json_messages_stream(spark, src, scratch_path(spark, "jout"), rej, scratch_path(spark, "jck"))
    assert sorted(tuple(r) for r in out.collect()) == [("t1", "a"), ("t3", "c")]
    assert spark.read.parquet(rej).count() == 1


def test_country_counts(spark):
    csv = _write(spark, "flights", "DEST_COUNTRY_NAME,ORIGIN_COUNTRY_NAME,count\n"
                 "US,Romania,15\nUS,,1\nUS,Ireland,344\nEgypt,US,15\n", "f.csv")
    got = {r.DEST_COUNTRY_NAME: r["count"] for r in J.country_counts(spark, csv, scratch_path(spark, "cc")).collect()}
    assert got == {"US": 2, "Egypt": 1}


def test_emissions_summary(spark):
    csv = _write(spark, "emissions", "Year,Country,Gas,Emissions (metric tons CO2e)\n"
                 "2020,IN,CO2,1.5\n2020,IN,CH4,2.5\n2020,IN,CO2,1.0\n2021,US,CO2,4\n", "e.csv")
    out = {(r.Year, r.Country): (r.total_emission, r.gas_count)
           for r in J.emissions_summary(spark, csv, scratch_path(spark, "em")).collect()}
    assert out == {("2020", "IN"): (5.0, 2), ("2021", "US"): (4.0, 1)}


def test_clean_csv_ingest_two_arrivals(spark):
    landing = scratch_path(spark, "air_landing")
    os.makedirs(_local(landing), exist_ok=True)
    header = "Date;Time;CO(GT);;NO2 (µg/m3)\n"
    with open(os.path.join(_local(landing), "a.csv"), "w", encoding="utf-8") as f:
        f.write(header + "10/03/2004;18.00.00;2,6;;113\n10/03/2004;19.00.00;2;;92\n")
    out_path, ckpt = scratch_path(spark, "air_out"), scratch_path(spark, "air_ck")
    out = J.clean_csv_ingest(spark, landing, out_path, ckpt)
    assert set(out.columns) >= {"Date", "Time", "CO_GT", "NO2__µg_m3", "processed_timestamp"}
    assert dict(out.dtypes)["CO_GT"] == "double"
    assert sorted(r.CO_GT for r in out.collect()) == [2.0, 2.6]
    with open(os.path.join(_local(landing), "b.csv"), "w", encoding="utf-8") as f:
        f.write(header + "11/03/2004;00.00.00;1,2;;80\n")
    out = J.clean_csv_ingest(spark, landing, out_path, ckpt)     # only the new file is read
    assert out.count() == 3


def test_news_lines(spark):
    df = spark.createDataFrame([(D.NEWS_TEXT,)], "value string")
    got = [r.line for r in J.news_lines(df, "value", D.NEWS_CHANNELS).orderBy("pos").collect()]
    assert len(got) == 4 and got[1] == "By Nora Quay"


def test_distinct_top_rentals(spark):
    d = dt.datetime(2024, 3, 1, 8)
    rows = [(1, d), (1, d), (2, d + dt.timedelta(hours=1)), (3, d + dt.timedelta(days=1))]
    df = spark.createDataFrame(rows, "rental_id int, start_date timestamp_ntz")
    got = [tuple(r) for r in J.distinct_top_rentals(spark, df, "2024-03-01").collect()]
    assert got == [(1, d), (2, d + dt.timedelta(hours=1))]


def test_load_then_summarize(spark):
    csv = _write(spark, "trades_load", "Symbol,BuyOrSell,QuantityTraded\nA,Buy,3\nA,Buy,4\nA,Sell,1\n", "l.csv")
    out = J.load_then_summarize(spark, csv, scratch_path(spark, "stage"), "tributary_test_summary",
                                scratch_path(spark, "summary"))
    assert sorted(tuple(r) for r in out.collect()) == [("A", "Buy", 7), ("A", "Sell", 1)]


def test_sql_to_table(spark):
    depts = spark.createDataFrame([("IT", 3), ("IT", 5), ("HR", 2)], "depart string, emp_count_depart int")
    out = J.sql_to_table(spark, "select depart, max(emp_count_depart) as emp_count from {dept_counts} group by 1",
                         "tributary_test_sql", scratch_path(spark, "sqlt"), dept_counts=depts)
    assert sorted(tuple(r) for r in out.collect()) == [("HR", 2), ("IT", 5)]


def test_symmetric_sets(spark):
    a = spark.createDataFrame([(v,) for v in D.SET_1], "value int")
    b = spark.createDataFrame([(v,) for v in D.SET_2], "value int")
    out = {k: sorted(r.value for r in v.collect()) for k, v in J.symmetric_sets(a, b).items()}
    assert out == {"intersection": [4, 5], "union": list(range(1, 9)), "b_minus_a": [6, 7, 8],
                   "symmetric": [1, 2, 3, 6, 7, 8]}


def test_clean_csv_ingest_types_stay_stable(spark):
    landing = scratch_path(spark, "air_landing2")
    os.makedirs(_local(landing), exist_ok=True)
    header = "Date;CO(GT)\n"
    with open(os.path.join(_local(landing), "a.csv"), "w", encoding="utf-8") as f:
        f.write(header + "10/03/2004;2,5\n")
    out_path, ckpt = scratch_path(spark, "air_out2"), scratch_path(spark, "air_ck2")
    J.clean_csv_ingest(spark, landing, out_path, ckpt)
    with open(os.path.join(_local(landing), "b.csv"), "w", encoding="utf-8") as f:
        f.write(header + "11/03/2004;3\n")                # integers only: widened to double
    out = J.clean_csv_ingest(spark, landing, out_path, ckpt)
    assert dict(out.dtypes)["CO_GT"] == "double"
    assert sorted(r.CO_GT for r in out.collect()) == [2.5, 3.0]
