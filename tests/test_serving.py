import datetime as dt
import json

from stopgrid.operators import serving

D = dt.date(2024, 3, 4)


def fact(spark, rows):
    """rows: (date, stop_seq, hour, ops, board)"""
    return spark.createDataFrame(
        [("7", d, f"s{s}", s, h, o, b, 1.0, 100.0 * s, f"n{s}") for d, s, h, o, b in rows],
        "route_no string, date date, stop_id string, stop_seq int, hour int, ops bigint, board double, "
        "alight double, link_distance_m double, stop_name string",
    )


def test_summary_without_buses(spark):
    rows = serving.summary_by_hour(fact(spark, [(D, 1, 8, 0, 50.0), (D, 2, 8, 0, 5.0)])).collect()
    assert [(r["current_departures"], r["headway_min"], r["max_board_per_bus"], r["is_crowded"]) for r in rows] == [(0, None, None, 0)]


def test_summary_crowded_only_above_the_limit(spark):
    table = fact(spark, [(D, 1, 8, 2, 99.0), (D, 1, 9, 2, 99.1), (D, 2, 9, 1, 1.0)])
    got = {r["hour"]: (r["headway_min"], r["is_crowded"]) for r in serving.summary_by_hour(table, "7", "2024-03-04").collect()}
    assert got == {8: (30.0, 0), 9: (20.0, 1)}
    assert serving.summary_by_hour(table, "8").count() == 0


def test_stop_detail_filters(spark):
    table = fact(spark, [(D, 1, 8, 2, 9.0), (D, 2, 8, 0, 4.0)])
    row = serving.stop_detail_by_hour(table, "7", D, 2).first()
    assert (row["pass_buses"], row["board_total"], row["board_per_bus"], row["stop_name"]) == (0, 4.0, None, "n2")


def test_forecast_uses_the_weekday_and_zero_without_history(spark):
    monday, next_monday = D, D + dt.timedelta(days=7)
    table = fact(spark, [(monday, 1, 8, 2, 120.0), (next_monday, 1, 8, 4, 160.0), (monday, 2, 8, 0, 9.0)])
    rows = serving.forecast_weekday(table, "2024-04-01", 2).collect()
    got = {(r["date"], r["hour"]): r for r in rows}
    assert len(got) == 48
    hit = got[dt.date(2024, 4, 1), 8]
    assert (hit["forecast_departures"], hit["forecast_board_per_bus"], hit["crowded_flag"]) == (2.0, 50.0, 1)
    assert hit["forecast_headway_min"] == 30.0
    none = got[dt.date(2024, 4, 2), 8]
    assert (none["forecast_departures"], none["forecast_headway_min"], none["crowded_flag"]) == (0.0, None, 0)


def test_payload_keeps_nulls_and_order(spark):
    table = fact(spark, [(D, 1, 9, 0, 5.0), (D, 1, 8, 2, 9.0)])
    body = json.loads(serving.summary_payloads(table).first()["payload"])
    assert [h["hour"] for h in body["hours"]] == [8, 9] and body["hours"][1]["headway_min"] is None
    assert body["date"] == "2024-03-04" and body["action"] == "summary" and body["ok"] is True
    body = json.loads(serving.stop_detail_payloads(table).first()["payload"])
    assert body["stop_seq"] == 1 and body["hours"][0]["pass_buses"] == 2
    body = json.loads(serving.forecast_payloads(table, "2024-04-01").first()["payload"])
    assert body["days"] == 7 and len(body["hours"]) == 168 and body["hours"][0]["date"] == "2024-04-01"


def test_gold_reads_once(spark):
    hours, stops = serving.gold(fact(spark, [(D, 1, 8, 2, 9.0), (D, 2, 8, 3, 9.0)]))
    assert hours.first()["current_departures"] == 5 and stops.count() == 2


def test_day_window(spark):
    table = fact(spark, [(D + dt.timedelta(days=i), 1, 8, 1, 1.0) for i in range(20)])
    assert serving.day_window(table, D, 7).count() == 7
    assert serving.date_range(table, "2024-03-05", "2024-03-06").count() == 2
