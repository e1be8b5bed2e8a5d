import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from stopgrid.operators import trips

D = dt.date(2024, 3, 4)


def predictions(spark, rows):
    """rows: (hour, stop_seq, pass_buses, board, alight[, route, stop_id])"""
    full = [
        ((r[5] if len(r) > 5 else "7"), D, r[0], (r[6] if len(r) > 6 else f"s{r[1]}"), r[1], f"n{r[1]}", r[2], r[3], r[4])
        for r in rows
    ]
    schema = (
        "route_no string, date date, hour int, stop_id string, stop_seq int, stop_name string, "
        "pass_buses double, pred_board double, pred_alight double"
    )
    return spark.createDataFrame(full, schema)


def links(spark, distances, route="7"):
    return spark.createDataFrame(
        [(route, s, d) for s, d in distances], "route_no string, stop_seq int, link_distance_m double"
    )


def test_link_profile_quirks(spark):
    table = links(spark, [(1, 900.0), (2, 100.0), (2, 300.0), (3, 0.0), (4, None), (5, -60.0), (9, 500.0)])
    preds = predictions(spark, [(8, s, 1.0, 0.0, 0.0) for s in (1, 2, 3, 4, 5)])
    got = {r["stop_seq"]: r["link_distance_m"] for r in trips.link_profile(preds, table).collect()}
    mean = (200.0 - 60.0 + 500.0) / 3  # zero and null are left out, the negative one counts
    assert got == {1: 0.0, 2: 200.0, 3: pytest.approx(mean), 4: pytest.approx(mean), 5: pytest.approx(mean)}


def test_stop_profile_defaults(spark):
    preds = predictions(
        spark, [(8, 1, 1.0, 0.0, 0.0), (8, 2, 1.0, 0.0, 0.0), (9, 2, 1.0, 0.0, 0.0, "7", "a0"), (8, 2, 1.0, 0.0, 0.0, "8")]
    )
    got = {
        (r["route_no"], r["stop_seq"]): (r["stop_id"], r["link_distance_m"], r["link_source"])
        for r in trips.stop_profile(preds, links(spark, [(1, 50.0), (3, 400.0)])).collect()
    }
    assert got == {("7", 1): ("s1", 0.0, "links"), ("7", 2): ("a0", 400.0, "links"), ("8", 2): ("s2", 300.0, "default")}
    plain = {(r["route_no"], r["stop_seq"]): r["link_distance_m"] for r in trips.stop_profile(preds).collect()}
    assert plain == {("7", 1): 0.0, ("7", 2): 300.0, ("8", 2): 300.0}


def test_departures_round_half_to_even_and_add_up_duplicates(spark):
    preds = predictions(
        spark,
        [(5, 1, 2.5, 0.0, 0.0), (6, 1, 3.5, 0.0, 0.0), (7, 1, 0.4, 0.0, 0.0), (8, 2, 9.0, 0.0, 0.0),
         (9, 1, 1.0, 0.0, 0.0, "7", "x"), (9, 1, 2.0, 0.0, 0.0, "7", "y")],
    )
    rows = trips.expand_departures(preds).orderBy("bus_id").collect()
    assert [r["bus_id"] for r in rows] == [
        "20240304-05-01", "20240304-05-02",
        "20240304-06-01", "20240304-06-02", "20240304-06-03", "20240304-06-04",
        "20240304-09-01", "20240304-09-02", "20240304-09-03",
    ]
    assert rows[1]["departure_us"] == (5 * 60 + 30) * 60_000_000 and rows[1]["headway_min"] == 30.0


def loop(departure_us, stops):
    """Arrival times by a plain loop over the stops."""
    start = dt.datetime.combine(D, dt.time()) + timedelta(microseconds=departure_us)
    arrival, out = start, []
    for seq, distance in stops:
        if seq == 1:
            arrival = start
        else:
            kmh = 15 if 7 <= arrival.hour <= 9 or 17 <= arrival.hour <= 19 else 22
            arrival = arrival + timedelta(minutes=distance / (kmh * 1000.0 / 60.0))
        out.append(arrival)
    return out


@pytest.mark.parametrize(
    "departure",
    [(6 * 60 + 55) * 60_000_000, (9 * 60 + 59) * 60_000_000 + 7, (16 * 60 + 50) * 60_000_000, (23 * 60 + 50) * 60_000_000],
)
def test_arrivals_match_a_plain_loop(spark, departure):
    stops = [(1, 0.0), (2, 3000.0), (3, 9000.0), (4, 123.4), (5, 7777.7)]
    departures = spark.createDataFrame([("7", D, "b", departure)], "route_no string, date date, bus_id string, departure_us bigint")
    profile = spark.createDataFrame(
        [("7", D, s, d, f"s{s}", None) for s, d in stops],
        "route_no string, date date, stop_seq int, link_distance_m double, stop_id string, stop_name string",
    )
    rows = trips.propagate_arrivals(departures, profile).orderBy("stop_seq").collect()
    midnight = dt.datetime.combine(D, dt.time())
    assert [midnight + timedelta(microseconds=r["arrival_us"]) for r in rows] == loop(departure, stops)


def test_worked_example_of_the_speed_change(spark):
    got = loop((6 * 60 + 55) * 60_000_000, [(1, 0.0), (2, 3000.0), (3, 9000.0)])
    assert [t.time().isoformat() for t in got[1:]] == ["07:03:10.909091", "07:39:10.909091"]


def test_allocation_after_midnight_and_crowding(spark):
    preds = predictions(
        spark,
        [(23, 1, 1.0, 40.0, 0.0), (23, 2, 1.0, 10.0, 20.0), (0, 2, 1.0, 99.0, 0.0), (23, 3, 1.0, 0.0, 35.0), (0, 3, 1.0, 99.0, 0.0)],
    )
    demand = trips.demand_totals(preds, ["pred_board"], ["pred_alight"])
    rows = trips.allocation(preds, demand, links(spark, [(2, 1000.0), (3, 22000.0)])).orderBy("stop_seq").collect()
    # stop 3 is reached on the next day: its hour matches no demand of the service day
    assert [r["board_total"] for r in rows] == [40.0, 10.0, None]
    assert [r["onboard_after"] for r in rows] == [40.0, 30.0, 30.0]
    assert [r["crowding"] for r in rows] == ["normal", "free", "free"]
    stored = trips.allocation_table(trips.allocation(preds, demand, links(spark, [(2, 1000.0), (3, 22000.0)])))
    last = stored.where("stop_seq = 3").first()
    assert last["arrival_ts"].date() == dt.date(2024, 3, 5) and last["date"] == D and last["arrival_hour"] == 0


def test_shares_add_up_and_windows_agree_with_the_fold(spark):
    rows = [(h, s, 3.0 if s == 1 else 1.0, 10.0 * s + h, 7.0 * s) for h in range(6, 12) for s in range(1, 8)]
    preds = predictions(spark, rows)
    demand = trips.demand_totals(preds, ["pred_board"], ["pred_alight"])
    table = trips.allocation(preds, demand, links(spark, [(s, 900.0) for s in range(2, 8)]))
    sums = (
        table.where("board_total is not null")
        .groupBy("stop_seq", F.expr("arrival_us div 3600000000").alias("h"))
        .agg(F.sum("board_per_bus").alias("s"), F.max("board_total").alias("t"), F.count("*").alias("n"), F.max("buses_in_hour").alias("b"))
        .collect()
    )
    assert sums and all(r["s"] == pytest.approx(r["t"]) and r["n"] == r["b"] for r in sums)
    again = trips.onboard_by_bus(
        table.select("route_no", "bus_id", "stop_seq", "board_per_bus", "alight_per_bus",
                     F.col("onboard_after").alias("folded"), F.col("onboard_before").alias("folded_before"))
    ).collect()
    assert all(r["onboard_after"] == pytest.approx(r["folded"]) for r in again)
    assert all(r["onboard_before"] == pytest.approx(r["folded_before"]) for r in again)


def test_dip_below_zero_is_remembered(spark):
    rows = spark.createDataFrame(
        [("7", "b", 1, 2.0, 0.0), ("7", "b", 2, 0.0, 5.0), ("7", "b", 3, 4.0, 0.0)],
        "route_no string, bus_id string, stop_seq int, board_per_bus double, alight_per_bus double",
    )
    got = trips.onboard_by_bus(rows).orderBy("stop_seq").collect()
    assert [r["onboard_after"] for r in got] == [2.0, 0.0, 1.0]


def test_two_routes_with_equal_bus_ids_stay_apart(spark):
    preds = predictions(
        spark,
        [(8, 1, 1.0, 5.0, 0.0), (8, 2, 1.0, 0.0, 1.0), (8, 1, 1.0, 50.0, 0.0, "8"), (8, 2, 1.0, 0.0, 1.0, "8")],
    )
    demand = trips.demand_totals(preds, ["pred_board"], ["pred_alight"])
    rows = trips.allocation(preds, demand).collect()
    got = {(r["route_no"], r["stop_seq"]): r["onboard_after"] for r in rows}
    assert got == {("7", 1): 5.0, ("7", 2): 4.0, ("8", 1): 50.0, ("8", 2): 49.0}


def test_rows_without_sequence_and_stops_without_id(spark):
    """A bad sequence stops nothing, and a known stop id goes before a missing one."""
    preds = predictions(spark, [(8, 1, 2.0, 5.0, 0.0), (8, 2, 2.0, 0.0, 1.0)])
    bad = preds.withColumn("stop_seq", F.lit(None).cast(preds.schema["stop_seq"].dataType))
    unnamed = preds.withColumn("stop_id", F.lit(None).cast("string"))
    both = preds.unionByName(bad).unionByName(unnamed.withColumn("pass_buses", F.lit(0.0)))
    names = {r["stop_seq"]: r["stop_id"] for r in trips.stop_profile(both).collect()}
    assert set(names) == {1, 2} and None not in names.values()
    demand = trips.demand_totals(both, ["pred_board"], ["pred_alight"])
    rows = trips.allocation(both, demand).collect()
    assert len(rows) == 4 and {r["stop_seq"] for r in rows} == {1, 2}


def test_hours_become_trips_after_the_join(spark):
    preds = predictions(spark, [(8, 1, 300.0, 5.0, 0.0), (8, 2, 300.0, 0.0, 1.0), (9, 1, 2.0, 1.0, 1.0), (9, 2, 2.0, 1.0, 1.0)])
    profile = trips.stop_profile(preds)
    one = trips.propagate_arrivals(trips.expand_departures(preds), profile)
    two = trips.explode_trips(trips.trips_of_hours(trips.hourly_departures(preds), trips.day_stops(profile)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() == 604


def test_demand_totals_by_columns_present(spark):
    df = spark.createDataFrame([(2.0, "3", -4.0)], "pass_buses double, `버스당_승차` string, `하차` double")
    row = trips.demand_totals(df).first()
    assert (row["board_total"], row["alight_total"]) == (6.0, 0.0)
    row = trips.demand_totals(df.select("pass_buses")).first()
    assert (row["board_total"], row["alight_total"]) == (0.0, 0.0)
