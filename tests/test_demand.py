import datetime as dt

import pytest
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.operators import demand, reshape

D1, D2 = dt.date(2024, 1, 31), dt.date(2024, 2, 1)


def monthly(spark, rows):
    schema = "use_ym string, route_no string, stop_id string, hour int, board_total bigint, alight_total bigint"
    return spark.createDataFrame(rows, schema)


def daily(spark, rows):
    schema = "date date, route_no string, stop_id string, stop_name string, board_total bigint, alight_total bigint"
    return spark.createDataFrame(rows, schema)


def ops(spark, rows):
    schema = "date date, route_no string, rte_id string, stop_id string, stop_seq int, hour int, ops bigint"
    return spark.createDataFrame(rows, schema)


def test_weights_sum_to_one_and_zero_total_is_even(spark):
    rows = [("202401", "7", "a", h, h, 0) for h in range(24)]
    got = {r["hour"]: r for r in demand.hour_weights(monthly(spark, rows)).collect()}
    assert got[5]["w_board"] == 5 / 276 and got[5]["w_alight"] == 1 / 24
    assert sum(r["w_board"] for r in got.values()) == pytest.approx(1.0)


def test_duplicate_monthly_rows_are_added(spark):
    rows = [("202401", "7", "a", 1, 2, 1), ("202401", "7", "a", 1, 4, 1), ("202401", "7", "a", 2, 6, 2)]
    got = {r["hour"]: r["w_board"] for r in demand.hour_weights(monthly(spark, rows)).collect()}
    assert got == {1: 0.5, 2: 0.5}


def test_disaggregation(spark):
    table = ops(
        spark,
        [(D1, "7", "r7", "a", 1, h, 2) for h in range(24)]
        + [(D2, "7", "r7", "a", 1, 8, 1)]
        + [(D1, "8", "r8", "a", 1, 8, 1)]
        + [(D1, "7", "r7", "b", 2, 8, 1)],
    )
    totals = daily(
        spark,
        [(D1, "7", "a", "A", 240, 48), (D2, "7", "a", "A", 100, 10), (D1, "8", "a", "A8", 24, 24)],
    )
    weights = monthly(
        spark,
        [("202401", "7", "a", h, 10, 2) for h in range(24)] + [("202402", "7", "a", 8, 1, 1), ("202402", "7", "a", 9, 3, 0)],
    )
    got = {
        (r["date"], r["route_no"], r["stop_id"], r["hour"]): r
        for r in demand.disaggregate_demand(table, totals, weights).collect()
    }
    assert len(got) == 27
    # all hours present: the hours add up to the day
    assert sum(r["board"] for k, r in got.items() if k[:3] == (D1, "7", "a")) == pytest.approx(240)
    # the weights are those of the date's own month
    assert got[D2, "7", "a", 8]["board"] == 25.0 and got[D2, "7", "a", 8]["alight"] == 10.0
    # the other route does not borrow this route's weights
    assert got[D1, "8", "a", 8]["board"] == pytest.approx(1.0)
    # no totals: zero, no name
    assert got[D1, "7", "b", 8]["board"] == 0.0 and got[D1, "7", "b", 8]["stop_name"] is None


def test_hour_without_weight_takes_a_24th(spark):
    table = ops(spark, [(D1, "7", "r7", "a", 1, 8, 2)])
    totals = daily(spark, [(D1, "7", "a", "A", 48, 24)])
    weights = monthly(spark, [("202401", "7", "a", 9, 5, 5)])
    row = demand.disaggregate_demand(table, totals, weights).first()
    assert (row["board"], row["alight"]) == (2.0, 1.0)
    row = demand.disaggregate_demand(table, totals, None).first()
    assert (row["board"], row["alight"]) == (2.0, 1.0)


def test_loop_route_keeps_the_last_visit_per_hour(spark):
    table = ops(
        spark,
        [(D1, "7", "r7", "a", 1, 8, 10), (D1, "7", "r7", "a", 9, 8, 20), (D1, "7", "r7", "a", 1, 9, 30)],
    )
    rows = demand.disaggregate_demand(table, daily(spark, []), monthly(spark, [])).collect()
    assert {(r["hour"], r["stop_seq"], r["ops"]) for r in rows} == {(8, 9, 20), (9, 1, 30)}


def test_loop_route_in_wide_rows(spark):
    names = {h: f"ops_{h:02d}" for h in range(24)}
    schema = "date date, route_no string, rte_id string, stop_id string, stop_seq int, " + ", ".join(
        f"{c} string" for c in names.values()
    )
    table = spark.createDataFrame(
        [(D1, "7", "r7", "a", 1, *["1"] * 24), (D1, "7", "r7", "a", 9, *["2"] * 24)], schema
    )
    rows = demand.stop_days_from_wide(table, names).collect()
    assert len(rows) == 1 and rows[0]["stop_seq"] == 9 and {x["ops"] for x in rows[0]["hours"]} == {2}


def test_links_by_stop_then_by_sequence_without_fan_out(spark):
    rows = spark.createDataFrame(
        [("r7", "a", 1), ("r7", "b", 2), ("r7", "c", 3), ("r8", "a", 1)],
        "route_key string, stop_id string, stop_seq int",
    )
    links = spark.createDataFrame(
        [
            ("r7", "a", 1, 100.0), ("r7", "a", 1, 300.0),
            ("r7", "y", 2, 50.0), ("r7", "z", 2, 70.0), ("r7", "b", 2, None),
        ],
        "route_key string, stop_id string, stop_seq int, link_distance_m double",
    )
    got = {(r["route_key"], r["stop_id"]): r["link_distance_m"] for r in demand.fill_links(rows, links).collect()}
    assert got == {("r7", "a"): 200.0, ("r7", "b"): 60.0, ("r7", "c"): None, ("r8", "a"): None}


def test_uniform_weights(spark):
    table = ops(spark, [(D1, "7", "r7", "a", 1, 8, 2), (D2, "7", "r7", "a", 1, 8, 2)])
    rows = demand.uniform_weights(table).collect()
    assert len(rows) == 24 and {r["w_board"] for r in rows} == {1 / 24}


def test_unpivot_finds_hour_columns_but_not_the_day_total(spark):
    df = spark.createDataFrame(
        [("a", "10", "3", None)],
        f"id string, `{S.OPS_WIDE_NAMES['ops_day']}` string, `{S.hour_tag(7)}` string, `{S.hour_tag(8)}` string",
    )
    hours = reshape.hour_columns(df, S.HOUR_TAG_PREFIX, S.HOUR_TAG_SUFFIX)
    assert hours == {7: S.hour_tag(7), 8: S.hour_tag(8)}
    assert [tuple(r) for r in reshape.unpivot_hours(df, hours, ["id"]).collect()] == [("a", 7, 3.0), ("a", 8, None)]
    assert [tuple(r) for r in reshape.unpivot_hours_zero(df, hours, ["id"]).collect()] == [("a", 7, 3), ("a", 8, 0)]


def test_explode_range_over_several_chunks(spark):
    df = spark.createDataFrame([("x", 2500), ("y", 0), ("z", 1)], "k string, n bigint")
    rows = reshape.explode_range(df, F.lit(0), F.col("n"), "i")
    got = {r["k"]: (r["c"], r["s"]) for r in rows.groupBy("k").agg(F.count("*").alias("c"), F.sum("i").alias("s")).collect()}
    assert got == {"x": (2500, sum(range(2500))), "z": (1, 0)}


def test_links_as_of_the_day(spark):
    import datetime as dt

    day = lambda n: dt.date(2025, 6, n)
    rows = spark.createDataFrame([(day(d), r, "a", 1) for d in (1, 3, 5, 9) for r in ("r1", "r2")], "date date, route_key string, stop_id string, stop_seq int")
    dated = [("20250603", "r1", "a", 1, 30.0), ("2025-06-05", "r1", "a", 1, 50.0), ("20250604", "r2", "zz", 7, 1.0), (None, "r1", "a", 1, 7.0), (None, "r2", "a", 1, 8.0)]
    links = spark.createDataFrame(dated, "date string, route_key string, stop_id string, stop_seq int, link_distance_m double")
    got = {(r["route_key"], r["date"].day): r["link_distance_m"] for r in demand.fill_links(rows, links, as_of=True).collect()}
    # before the first dated links the undated ones; a later day keeps the newest, and a route's links count as a whole
    assert got == {("r1", 1): 7.0, ("r1", 3): 30.0, ("r1", 5): 50.0, ("r1", 9): 50.0, ("r2", 1): 8.0, ("r2", 3): 8.0, ("r2", 5): None, ("r2", 9): None}
    exact = {(r["route_key"], r["date"].day): r["link_distance_m"] for r in demand.fill_links(rows, links).collect()}
    assert exact[("r1", 9)] == 7.0 and exact[("r1", 3)] == 30.0
