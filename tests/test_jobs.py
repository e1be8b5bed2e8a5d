"""The jobs end to end on small files in the input formats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stopgrid import jobs, schema as S
from stopgrid.operators import merge
from stopgrid.sources import files
from tests.test_sources import land, page, write

D1, D2 = dt.date(2025, 6, 1), dt.date(2025, 6, 2)
HOURS = [S.hour_tag(h) for h in range(24)]


def wide_csv(path, rows):
    """rows: (date, key, stop, seq, route, {hour: text})"""
    names = S.OPS_WIDE_NAMES
    header = [names[n] for n in ("date", "route_key", "stop_id", "stop_seq", "route_no", "ops_day")] + HOURS
    lines = [",".join(header)]
    for date, key, stop, seq, route, counts in rows:
        lines.append(",".join([date, key, stop, seq, route, "99", *[counts.get(h, "") for h in range(24)]]))
    return write(path, lines)


def test_bronze_silver_gold(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    june = wide_csv(
        tmp_path / "june.csv",
        [(" 2025-06-01 ", " k1 ", "a", "1", "0017", {7: "3", 8: "x"}), ("2025-06-01", "k1", "b", "2", "0017", {7: "4"}),
         ("2025-06-02", "k1", "a", "1", "N26", {9: "1"})],
    )
    july = wide_csv(tmp_path / "july.csv", [("20250701", "k1", "a", "1", "0017", {7: "9"})])
    for csv in (june, july):
        jobs.bronze(spark, csv, bronze)
    rows = files.read_ops(spark, bronze, S.BRONZE).collect()
    assert {(r["use_ym"], r["date"], r["route_no"], r["stop_id"], r["stop_seq"]) for r in rows} == {
        ("202506", "20250601", "0017", "a", 1), ("202506", "20250601", "0017", "b", 2),
        ("202506", "20250602", "N26", "a", 1), ("202507", "20250701", "0017", "a", 1),
    }
    jobs.silver(spark, bronze, silver, use_ym="202506")
    jobs.silver(spark, bronze, silver, use_ym="202507", route_no="0017")
    hours, stops = jobs.gold(spark, silver, use_ym="202506", route_no="0017")
    got = {(r["date"], r["hour"]): r["current_departures"] for r in hours.collect() if r["current_departures"]}
    assert got == {("20250601", 7): 7}
    assert stops.where("hour = 7").count() == 2
    hours, _ = jobs.gold(spark, silver)
    assert hours.agg(F.sum("current_departures")).first()[0] == 17


def daily_page(rows):
    return page(
        S.DAILY_SERVICE,
        [{"USE_YMD": d, "RTE_ID": "r1", "RTE_NO": "0017", "STOPS_ID": s, "SBWY_STNS_NM": f"name {s}",
          "GTON_TNOPE": str(b), "GTOFF_TNOPE": str(a), "REG_YMD": "20250605"} for d, s, b, a in rows],
    )


def monthly_page(stop):
    row = {"USE_YM": "202506", "RTE_NO": "0017", "STOPS_ID": stop, "SBWY_STNS_NM": "n", "REG_YMD": "20250703"}
    for h in range(24):
        row[S.board_tags(h)[h % 2]] = str(h)
        row[S.alight_tags(h)[0]] = "1"
    return page(S.MONTHLY_SERVICE, [row])


def test_fact_table_with_ledger_and_source_order(spark, tmp_path):
    from stopgrid.sources import xml

    csv = wide_csv(tmp_path / "o.csv", [("20250601", "k1", "a", "1", "0017", {7: "3"}), ("20250601", "k9", "z", "1", "9", {7: "3"})])
    ops_page = {"RTE_ID": "r1", "STOPS_SEQ": "1", "BUS_OPR": "1"}
    pages = land(
        tmp_path / "pages",
        [page(S.OPS_SERVICE, [{**ops_page, "CRTR_DD": "20250601", "STOPS_ID": "other", "BUS_OPR_07": "8"},
                              {**ops_page, "CRTR_DD": "20250602", "STOPS_ID": "a", "BUS_OPR_07": "5"}])],
    )
    route_map = files.load_route_map(
        files.read_csv_strings(spark, write(tmp_path / "r.csv", ["노선_ID,RTE_ID,RTE_NO", "k1,r1,0017"]))
    )
    daily = xml.daily_rows(xml.read_pages(
        spark, land(tmp_path / "daily", [daily_page([("20250601", "a", 276, 24), ("20250602", "a", 552, 48)])]), S.DAILY_SERVICE))
    monthly = xml.monthly_rows(xml.read_pages(spark, land(tmp_path / "monthly", [monthly_page("a")]), S.MONTHLY_SERVICE))
    links = files.load_link_distance(
        files.read_csv_strings(spark, write(tmp_path / "l.csv", ["노선_ID,정류장_ID,링크_구간거리(m),정류장_순서", "r1,q,450.5,1"]))
    )
    out, ledger = str(tmp_path / "fact"), str(tmp_path / "ledger")
    days = [jobs.csv_stop_days(spark, csv, route_map), jobs.page_stop_days(spark, pages, route_map)]
    missing = dt.date(2025, 6, 3)
    jobs.build_fact(spark, out, ledger, days, daily, monthly, [links], [D1, D2, missing])
    fact = jobs.read_fact(spark, out, ledger)
    # the CSV serves 1 June alone, the pages 2 June; the unmapped route is dropped
    assert fact.count() == 48 and {r["stop_id"] for r in fact.select("stop_id").distinct().collect()} == {"a"}
    seven = {r["date"]: r for r in fact.where("hour = 7").collect()}
    assert (seven[D1]["ops"], seven[D1]["board"], seven[D1]["alight"]) == (3, 7.0, 1.0)
    assert (seven[D2]["ops"], seven[D2]["board"], seven[D2]["alight"]) == (5, 14.0, 2.0)
    assert seven[D1]["route_no"] == "0017" and seven[D1]["route_id"] == "r1" and seven[D1]["stop_name"] == "name a"
    assert seven[D1]["link_distance_m"] == 450.5
    book = spark.read.schema(S.RUN_LEDGER).parquet(ledger)
    assert {(r["target_date"], r["status"], r["message"]) for r in book.collect()} == {
        (D1, "OK", "rows=24"), (D2, "OK", "rows=24"), (missing, "NO_DATA", "rows=0")
    }
    # a second run only tries the date without data
    jobs.build_fact(spark, out, ledger, days, daily, monthly, [links], [D1, D2, missing])
    spark.catalog.refreshByPath(ledger)
    book = spark.read.schema(S.RUN_LEDGER).parquet(ledger)
    assert book.count() == 6 and book.where(F.col("target_date") == missing).count() == 2
    assert {r["target_date"] for r in book.where("status = 'SKIPPED_SAME_DATE'").collect()} == {D1, D2}
    # a date whose input is incomplete is refused, and what lies there is not counted
    bad = spark.createDataFrame([(missing,)], "date date")
    jobs.build_fact(spark, out, ledger, days, daily, monthly, [links], [missing], bad)
    spark.catalog.refreshByPath(ledger)
    last = merge.ledger_latest(spark.read.schema(S.RUN_LEDGER).parquet(ledger)).first()
    assert (last["target_date"], last["status"]) == (missing, "ERROR")
    assert merge.key_violations(jobs.read_fact(spark, out, ledger), S.KEYS["daily_stop_hour"]).count() == 0

    fact = jobs.read_fact(spark, out, ledger)
    jobs.export_fact(fact, str(tmp_path / "csv"))
    raw = files.read_csv_strings(spark, str(tmp_path / "csv"))
    assert raw.count() == 48 and "링크_구간거리(m)" in raw.columns


@pytest.fixture
def small_fact(spark, tmp_path):
    """Two routes on two days, and a function that builds their fact table."""

    def days(ops):
        rows = [(d, r, "s1", 1, ops) for d in (D1, D2) for r in ("0017", "N26")]
        wide = spark.createDataFrame(rows, "date date, route_no string, stop_id string, stop_seq int, ops bigint")
        hour = F.array(F.struct(F.lit(7).alias("hour"), F.col("ops")))
        return wide.select("date", "route_no", F.col("route_no").alias("rte_id"), "stop_id", "stop_seq", hour.alias("hours"))

    daily = spark.createDataFrame([], S.DEMAND_DAILY_STOP)
    links = spark.createDataFrame([], S.DIM_STOP_LINK)
    out, ledger = str(tmp_path / "fact"), str(tmp_path / "ledger")

    def build(ops, **more):
        given = days(ops)
        if extra := more.pop("extra", None):
            given = extra(given)
        return jobs.build_fact(spark, out, ledger, [given], daily, None, [links], [D1, D2], **more)

    def read():
        for path in (out, ledger):
            spark.catalog.refreshByPath(path)
        return {(r["date"].day, r["route_no"]): r["ops"] for r in jobs.read_fact(spark, out, ledger).collect()}

    return build, read, out, ledger


def test_refused_routes_alone_are_left_out(spark, small_fact):
    build, read, out, ledger = small_fact
    bad = spark.createDataFrame([(D1, "0017"), (dt.date(2025, 7, 1), None)], "date date, route_no string")
    build(1, incomplete=bad)
    assert read() == {(1, "N26"): 1, (2, "0017"): 1, (2, "N26"): 1}
    said = {r["target_date"]: (r["status"], r["message"]) for r in jobs.read_ledger(spark, ledger).collect()}
    assert said == {D1: ("ERROR", "input is incomplete: 0017; rows=1"), D2: ("OK", "rows=2")}
    # the date is tried again; what is refused now keeps what it had
    build(5, incomplete=spark.createDataFrame([(D1, "N26")], "date date, route_no string"))
    assert read() == {(1, "N26"): 1, (1, "0017"): 5, (2, "0017"): 1, (2, "N26"): 1}
    with pytest.raises(jobs.IncompleteInput):
        build(6, incomplete=spark.createDataFrame([(None, None)], "date date, route_no string"))
    build(6, incomplete=spark.createDataFrame([(D1, None)], "date date, route_no string"))
    assert read() == {(1, "N26"): 1, (1, "0017"): 5, (2, "0017"): 1, (2, "N26"): 1}


def test_a_run_that_fails_before_the_ledger_is_not_seen(spark, small_fact, monkeypatch):
    build, read, out, ledger = small_fact
    build(1, incomplete=spark.createDataFrame([(D1, "0017")], "date date, route_no string"))
    before = read()

    def broken(*_):
        raise OSError("ledger not reached")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "append_ledger", broken)
        with pytest.raises(OSError, match="not reached"):
            build(9)
    assert read() == before
    run = build(3)
    assert read() == {(1, "0017"): 3, (1, "N26"): 3, (2, "0017"): 1, (2, "N26"): 1}
    # the failed run's folder of 1 June and the replaced one go, what counts stays
    assert jobs.vacuum_fact(spark, out, ledger) == 2
    assert read() == {(1, "0017"): 3, (1, "N26"): 3, (2, "0017"): 1, (2, "N26"): 1}
    assert jobs.vacuum_fact(spark, out, ledger) == 0
    assert {r["run_id"] for r in merge.ledger_runs(jobs.read_ledger(spark, ledger), S.FACT_JOB).where(F.col("date") == D1).collect()} == {run}


def test_rows_with_bad_keys_go_to_quarantine(spark, small_fact, tmp_path):
    build, read, out, ledger = small_fact
    aside = str(tmp_path / "aside")

    def spoil(rows):
        null = rows.where("route_no = 'N26'").limit(1).withColumn("stop_id", F.lit(None).cast("string"))
        twice = rows.where((F.col("route_no") == "0017") & (F.col("date") == F.lit(D1)))
        return rows.unionByName(null).unionByName(twice)

    with pytest.raises(ValueError, match="key"):
        build(1, extra=spoil)
    run = build(1, extra=spoil, quarantine=aside)
    assert read() == {(1, "N26"): 1, (2, "0017"): 1, (2, "N26"): 1}
    bad = spark.read.parquet(aside).collect()
    assert sorted((r["reason"], r["route_no"]) for r in bad) == [("null key", "N26"), ("repeated key", "0017"), ("repeated key", "0017")]
    assert {r["run_id"] for r in bad} == {run}


def test_pages_without_a_route_map(spark, tmp_path):
    row = {"CRTR_DD": "20250601", "RTE_ID": "r1", "STOPS_ID": "a", "STOPS_SEQ": "1", "BUS_OPR": "1", "BUS_OPR_07": "8"}
    pages = land(tmp_path / "pages", [page(S.OPS_SERVICE, [row])])
    assert [(r["route_no"], r["rte_id"]) for r in jobs.page_stop_days(spark, pages).collect()] == [("r1", "r1")]


def test_dated_links_go_before_undated_ones(spark, tmp_path):
    """The stop master of the day, else the link file; the days are not averaged."""
    from stopgrid.operators import demand

    master = files.load_stop_master(files.read_csv_strings(spark, write(
        tmp_path / "m.csv", ["CRTR_DD,노선_ID,정류장_ID,정류장_순서,링크_구간거리(m)", "20250601,r1,a,1,100", "2025-06-02,r1,a,1,900"])))
    links = files.load_link_distance(files.read_csv_strings(spark, write(
        tmp_path / "l.csv", ["노선_ID,정류장_ID,링크_구간거리(m),정류장_순서", "r1,a,5,1", "r2,b,7,2"])))
    stops = [(d, r, s, q) for d in (D1, D2, dt.date(2025, 6, 3)) for r, s, q in (("r1", "a", 1), ("r1", "x", 1), ("r2", "b", 9))]
    rows = spark.createDataFrame(stops, "date date, route_key string, stop_id string, stop_seq int")
    both = jobs.link_sources([master, links])
    got = {(r["date"].day, r["stop_id"]): r["link_distance_m"] for r in demand.fill_links(rows, both).collect()}
    assert got == {
        (1, "a"): 100.0, (1, "x"): 100.0, (2, "a"): 900.0, (2, "x"): 900.0, (3, "a"): 5.0, (3, "x"): 5.0,
        (1, "b"): 7.0, (2, "b"): 7.0, (3, "b"): 7.0,
    }
    assert merge.prefer([master, links], ["route_key"]).count() == 3


def test_prediction_files_of_different_shape(spark, tmp_path):
    one = write(tmp_path / "1.csv", ["route_no,DATE,HOUR,STOP_ID,STOP_SEQ,STOP_NAME,departures,yhat_board_total,yhat_alight_total,per_bus_board,per_bus_alight,per_bus_onboard", "7,2025-06-01,5,a,1,n,3,40,10,1,1,0"])
    two = write(tmp_path / "2.csv", ["HOUR,DATE,route_no,STOP_NAME,STOP_SEQ,STOP_ID,yhat_alight_total,yhat_board_total,departures,per_bus_onboard,per_bus_alight,per_bus_board", "6,2025-06-02,8,m,2,b,11,41,4,0,2,3"])
    rows = merge.coerce_predictions(files.read_predictions(spark, [one, two])).orderBy("date").collect()
    assert [(r["route_no"], r["hour"], r["stop_id"], r["stop_seq"], r["pass_buses"], r["pred_board"], r["pred_alight"], r["board_per_bus"]) for r in rows] == [
        ("7", 5, "a", 1, 3.0, 40.0, 10.0, 1.0), ("8", 6, "b", 2, 4.0, 41.0, 11.0, 3.0)
    ]


def test_operations_without_a_route_map(spark, tmp_path):
    csv = wide_csv(tmp_path / "o.csv", [("20250601", "k1", "a", "1", "0017", {7: "3"}), ("20250602", "k1", "a", "1", "0017", {7: "4"})])
    rows = jobs.csv_stop_days(spark, csv, dates=[D2]).collect()
    assert [(r["date"], r["rte_id"], r["route_no"]) for r in rows] == [(D2, "k1", "0017")]


def test_predictions_schedule_and_reallocation(spark, tmp_path):
    table, sched, alloc, moved, slots = (str(tmp_path / n) for n in ("p", "s", "a", "m", "slots"))
    header = "route_no,DATE,HOUR,STOP_ID,STOP_SEQ,STOP_NAME,departures,yhat_board_total,yhat_alight_total,per_bus_board,per_bus_alight,per_bus_onboard"
    lines = [header]
    for h in range(5, 22):
        buses, board = (9, 40) if h < 12 else (1, 400)
        for s in (1, 2, 3):
            lines.append(f"7,2025-06-01,{h},s{s},{s},n{s},{buses},{board},10,bad,,0")
    path = write(tmp_path / "preds.csv", lines)
    jobs.ingest_predictions(spark, [path], table)
    jobs.ingest_predictions(spark, [path], table)
    preds = files.read_partitioned(spark, table, S.PREDICTIONS)
    assert preds.count() == 51 and preds.where("board_per_bus = 0").count() == 51
    jobs.build_schedule(preds, None, sched, alloc, "2025-06-01", "2025-06-01")
    timetable = files.read_partitioned(spark, sched, S.FINAL_SCHEDULE)
    loads = files.read_partitioned(spark, alloc, S.FINAL_ALLOCATION)
    assert timetable.count() == loads.count() == (7 * 9 + 10) * 3
    assert merge.key_violations(loads, S.KEYS["final_allocation"]).count() == 0
    jobs.build_reallocation(preds, moved, slots)
    assert spark.read.parquet(slots).count() == 7 * 9 + 10
    moves = spark.read.parquet(moved)
    assert moves.count() > 0 and moves.where("from_hour < 8 or to_hour > 18").count() == 0


def test_prediction_job(spark):
    from stopgrid.sources import tables

    fact = tables.daily_stop_hour(spark, "/root/testdata/sf0.01")
    out = jobs.predict(fact, tables.SPLITS)
    assert out.columns == S.PREDICTIONS.fieldNames()
    row = out.agg(
        F.count("*").alias("n"), F.min("pred_board").alias("lo"), F.min("onboard_per_bus").alias("ob"),
        F.sum(F.col("stop_name").isNull().cast("int")).alias("unnamed"),
        F.min("date").alias("first"), F.max("date").alias("last"),
    ).first()
    assert row["n"] > 0 and row["lo"] >= 0 and row["ob"] >= 0 and row["unnamed"] == 0
    assert dt.date(2024, 1, 22) <= row["first"] <= row["last"]


def test_dimensions_and_demand_tables(spark, tmp_path):
    tables = [str(tmp_path / n) for n in ("map", "link", "day", "month")]
    for rte, metres in (("r1", "100"), ("r2", "200")):
        jobs.load_dimensions(
            spark,
            write(tmp_path / "r.csv", ["노선_ID,RTE_ID,RTE_NO", f"k1,{rte},0017"]),
            write(tmp_path / "l.csv", ["노선_ID,정류장_ID,링크_구간거리(m),정류장_순서", f"k1,a,{metres},1", f"k1,{rte},5,2"]),
            *tables[:2],
        )
    assert [tuple(r) for r in spark.read.parquet(tables[0]).collect()] == [("k1", "r2", "0017")]
    links = {(r["stop_id"], r["link_distance_m"]) for r in spark.read.parquet(tables[1]).collect()}
    assert links == {("a", 200.0), ("r1", 5.0), ("r2", 5.0)}
    daily = land(tmp_path / "daily", [daily_page([("20250601", "a", 5, 1), ("20250602", "a", 6, 1)]), daily_page([("20250601", "a", 9, 1)])])
    monthly = land(tmp_path / "monthly", [monthly_page("a"), monthly_page("b")])
    for _ in range(2):
        jobs.load_demand(spark, daily, monthly, *tables[2:])
    days = files.read_partitioned(spark, tables[2], S.DEMAND_DAILY_STOP)
    assert {(r["date"], r["board_total"]) for r in days.collect()} == {(D1, 9), (D2, 6)}
    months = files.read_partitioned(spark, tables[3], S.DEMAND_MONTHLY_HOURLY)
    assert months.count() == 48 and months.agg(F.sum("board_total")).first()[0] == 2 * 276


def test_sequence_links(spark, tmp_path):
    raw = files.read_csv_strings(spark, write(tmp_path / "s.csv", ["노선번호,정류장_순서,링크_구간거리(m)", " 7 ,1,0", "7,2,x"]))
    assert [tuple(r) for r in files.load_sequence_links(raw).collect()] == [("7", 1, 0.0), ("7", 2, None)]
    assert files.load_sequence_links(raw.drop("노선번호"), "8").first()["route_no"] == "8"
    with pytest.raises(merge.MissingColumns):
        files.load_sequence_links(raw.drop("노선번호"))


def ops_row(date, stop, buses, route="r1"):
    return {"CRTR_DD": date, "RTE_ID": route, "STOPS_ID": stop, "STOPS_SEQ": "1", "BUS_OPR": "1", "BUS_OPR_07": str(buses)}


def test_operations_cache_parses_new_pages_alone(spark, tmp_path, monkeypatch):
    from stopgrid.sources import xml

    pages, cache, seen = (str(tmp_path / n) for n in ("pages", "cache", "seen"))
    read = []
    real = xml.read_pages
    monkeypatch.setattr(xml, "read_pages", lambda spark, path, service: read.append(sorted(p.rsplit("/", 1)[1] for p in path)) or real(spark, path, service))
    folder = tmp_path / "pages"
    land(folder, [page(S.OPS_SERVICE, [ops_row("20250601", "a", 3)]), page(S.OPS_SERVICE, [ops_row("20250602", "a", 4)])])
    assert jobs.refresh_ops_cache(spark, pages, cache, seen) == 2
    assert jobs.refresh_ops_cache(spark, pages, cache, seen) == 0
    land(folder / "later", [page(S.OPS_SERVICE, [ops_row("20250602", "a", 9), ops_row("20250603", "b", 1)])])
    assert jobs.refresh_ops_cache(spark, pages, cache, seen) == 1
    assert read == [["page_0.xml", "page_1.xml"], ["page_0.xml"]]
    seven = {(r["date"].day, r["stop_id"]): r["ops"] for r in jobs.read_ops_cache(spark, cache).where("hour = 7").collect()}
    assert seven == {(1, "a"): 3, (2, "a"): 9, (3, "b"): 1}
    asked = spark.createDataFrame([("r1", D2), ("r1", dt.date(2025, 7, 1))], "route_no string, date date")
    assert jobs.read_ops_cache(spark, cache, asked).count() == 24
    days = jobs.cached_stop_days(spark, cache, asked).collect()
    assert [(r["date"], r["stop_id"], len(r["hours"])) for r in days] == [(D2, "a", 24)]
    # a run that fails before the ledger is repeated, to the same end
    land(folder / "more", [page(S.OPS_SERVICE, [ops_row("20250601", "a", 7)])])
    with monkeypatch.context() as patch:
        patch.setattr(merge, "upsert_table", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            jobs.refresh_ops_cache(spark, pages, cache, seen)
    assert jobs.refresh_ops_cache(spark, pages, cache, seen) == 1
    assert jobs.read_ops_cache(spark, cache).where("hour = 7 and date = '2025-06-01'").first()["ops"] == 7


def test_weekday_states_follow_corrections(spark, tmp_path):
    from stopgrid.operators import serving

    states, totals = str(tmp_path / "states"), str(tmp_path / "totals")
    schema = "route_no string, date date, stop_id string, hour int, ops bigint, board double"
    week = [dt.date(2025, 6, d) for d in (1, 2, 8, 9)]
    first = [("r", d, s, 7, 2, 4.0 * i) for i, d in enumerate(week) for s in "ab"]
    jobs.refresh_weekdays(spark.createDataFrame(first, schema), week, states, totals)
    # a corrected date, one that lost its rows, one without buses
    second = [("r", week[0], "a", 7, 5, 50.0), ("r", week[3], "a", 8, 0, 1.0)]
    for _ in range(2):
        jobs.refresh_weekdays(spark.createDataFrame(second, schema), [week[0], week[1], week[3]], states, totals)
    now = [r for r in first if r[1] == week[2]] + second
    expected = serving.weekday_hour_avg(spark.createDataFrame(now, schema))
    shown = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert shown(jobs.read_weekdays(spark, totals)) == shown(expected)
    assert shown(serving.forecast_from(jobs.read_weekdays(spark, totals), "2025-07-01", 7)) == shown(
        serving.forecast_weekday(spark.createDataFrame(now, schema), "2025-07-01", 7)
    )


def jobs_run(spark, action):
    """Spark jobs that an action starts."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("counted", "counted")
    before = len(tracker.getJobIdsForGroup("counted"))
    try:
        action()
    finally:
        sc._jsc.sc().clearJobGroup()
    return len(tracker.getJobIdsForGroup("counted")) - before


def test_headers_of_many_files_take_a_constant_number_of_jobs(spark, tmp_path):
    header = "route_no,DATE,HOUR,STOP_ID,STOP_SEQ,STOP_NAME,departures,yhat_board_total,yhat_alight_total,per_bus_board,per_bus_alight,per_bus_onboard"
    other = ",".join(reversed(header.split(",")))
    counts = {}
    for n in (4, 400):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            line = f"7,2025-06-01,5,s{i},1,n,3,40,10,1,1,0"
            swapped = ",".join(reversed(line.split(",")))
            text = f"{header}\n{line}\n" if i % 2 else f"\ufeff{other}\n{swapped}\n"
            (folder / f"p{i}.csv").write_text(text, encoding="utf-8")
        counts[n] = jobs_run(spark, lambda: files.read_predictions(spark, str(folder)))
        rows = merge.coerce_predictions(files.read_predictions(spark, str(folder))).select("stop_id", "hour", "pred_board").collect()
        assert {(r["stop_id"], r["hour"], r["pred_board"]) for r in rows} == {(f"s{i}", 5, 40.0) for i in range(n)}
    # one for the headers, one more where so many paths are listed by a job
    assert counts[4] <= 2 and counts[400] <= counts[4] + 3
    assert files.header_names('a,"b,c",,a') == ["a0", "b,c", "_c2", "a3"]


def test_links_of_a_stop_master(spark, tmp_path):
    out = str(tmp_path / "links")
    one = write(tmp_path / "1.csv", ["RTE_ID,STOP_ID,STOP_SEQ,LINK_DIST_M,DATE", "r1,a,1,10,20250601", "r1,a,1,12,20250601", "r1,b,x,5,20250601", "r2,c,3,4,20250601"])
    jobs.load_master_links(spark, one, out, route_key="k1", rte_id="r1", date="20250601")
    two = write(tmp_path / "2.csv", ["노선_ID,정류장_ID,정류장_순서,링크_구간거리(m)", "k1,a,1,15", "k2,z,2,", ",y,3,1"])
    jobs.load_master_links(spark, two, out)
    got = sorted((r["route_key"], r["stop_id"], r["stop_seq"], r["link_distance_m"]) for r in spark.read.parquet(out).collect())
    assert got == [("k1", "a", 1, 15.0), ("k2", "z", 2, None)]
