import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stopgrid.operators import features
from tests.test_trips import D


def series(spark, lengths, gap=1, split="train"):
    rows = []
    for stop, n in lengths.items():
        for i in range(n):
            rows.append((split, "7", stop, 1000 + i * gap, float(i), float(n)))
    return spark.createDataFrame(
        rows, "split string, route_no string, stop_id string, hour_index bigint, a double, b double"
    )


KEYS = ["split", "route_no", "stop_id"]


def test_24_rows_give_no_window_and_25_give_one(spark):
    rows = series(spark, {"x": 24, "y": 25, "z": 40})
    got = features.sequence_windows(rows, KEYS, features=["a", "b"]).collect()
    assert sorted((r["stop_id"], r["hour_index"]) for r in got) == [("y", 1024)] + [("z", 1000 + i) for i in range(24, 40)]
    first = next(r for r in got if r["stop_id"] == "y")
    assert [x["a"] for x in first["past"]] == [float(i) for i in range(24)]


@pytest.mark.parametrize("chunk", [1, 5, 7, 24, 1000])
@pytest.mark.parametrize("length", [1, 3, 24])
def test_chunked_windows_match_brute_force(spark, chunk, length):
    rnd = random.Random(chunk * 100 + length)
    table = {
        stop: sorted(rnd.sample(range(400), n)) for stop, n in {"p": 90, "q": 30, "r": length, "s": length + 1}.items()
    }
    rows = [("train", "7", s, t, float(t * 10 + i), 0.0) for s, ts in table.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(
        rows, "split string, route_no string, stop_id string, hour_index bigint, a double, b double"
    )
    got = {
        (r["stop_id"], r["hour_index"]): [x["a"] for x in r["past"]]
        for r in features.sequence_windows(df, KEYS, features=["a"], length=length, chunk=chunk).collect()
    }
    want = {}
    for s, ts in table.items():
        values = [float(t * 10 + i) for i, t in enumerate(ts)]
        for i in range(length, len(ts)):
            want[s, ts[i]] = values[i - length : i]
    assert got == want


def test_windows_restart_in_every_split(spark):
    rows = series(spark, {"x": 30}).unionByName(series(spark, {"x": 26}, split="val"))
    got = features.sequence_windows(rows, KEYS, features=["a"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 6, "val": 2}


def test_minmax_covers_rows_in_windows_only(spark):
    rows = series(spark, {"x": 24, "y": 25})  # x gives no window; y's last row is in none
    row = features.feature_minmax(rows, features=["a", "b"]).first()
    assert (row["a_min"], row["a_max"], row["b_min"], row["b_max"]) == (0.0, 23.0, 25.0, 25.0)
    scaled = features.scaled_windows(rows, features.feature_minmax(rows, features=["a", "b"]), KEYS, ["a", "b"])
    past = scaled.where("stop_id = 'y'").first()["past"]
    assert [x["a"] for x in past] == [i / 23.0 for i in range(24)]
    assert {x["b"] for x in past} == {0.0}  # a constant feature scales to 0


def fact(spark, rows):
    """rows: (stop, hour, ops, board, alight, distance)"""
    return spark.createDataFrame(
        [("7", D, s, 1, h, o, b, a, d) for s, h, o, b, a, d in rows],
        "route_no string, date date, stop_id string, stop_seq int, hour int, ops bigint, board double, "
        "alight double, link_distance_m double",
    )


def test_features(spark):
    table = fact(
        spark,
        [("a", 1, None, -4.0, None, 0.0), ("a", 2, 4, 5.0, 6.0, None), ("b", 1, 1, 5.0, 6.0, 100.0), ("b", 2, 1, 5.0, 6.0, 300.0)],
    )
    got = {(r["stop_id"], r["hour"]): r for r in features.demand_features(table).collect()}
    bad = got["a", 1]
    assert (bad["pass_buses"], bad["y_board"], bad["y_alight"], bad["headway_min"], bad["distance"]) == (0.0, 0.0, 0.0, 60.0, 200.0)
    assert got["a", 2]["distance"] == 200.0 and got["a", 2]["headway_min"] == 15.0 and got["b", 2]["distance"] == 300.0
    assert bad["dow"] == 0 and bad["is_weekend"] == 0 and bad["target_per_bus"] == 49.5
    without = features.demand_features(table.drop("link_distance_m"))
    assert {r["distance"] for r in without.collect()} == {300.0}


def test_stop_index_is_numeric_for_numbers(spark):
    df = spark.createDataFrame([("7", "10"), ("7", "9"), ("7", "9"), ("8", "b"), ("8", "a")], "route_no string, stop_id string")
    got = {(r["route_no"], r["stop_id"]): r["stop_idx"] for r in features.stop_index(df).collect()}
    assert got == {("7", "9"): 0, ("7", "10"): 1, ("8", "a"): 0, ("8", "b"): 1}
    assert features.index_stops(df).count() == 5


def test_split_windows_include_the_last_day(spark):
    bounds = {"train": ("2024-01-01", "2024-01-19"), "val": ("2024-01-20", "2024-01-21")}
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 19), dt.date(2024, 1, 20), dt.date(2024, 1, 22)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = features.with_split(df, bounds).orderBy("date").collect()
    assert [r["split"] for r in got] == ["train", "train", "val"]


def test_model_learns_a_linear_target(spark):
    rows = []
    for split, start in (("train", 0), ("test", 5000)):
        for i in range(200):
            x = float((i * 7) % 13)
            rows.append((split, "7", "a", start + i, D, x, 2.0 * float(((i - 1) * 7) % 13) + 5.0, 30.0))
    df = spark.createDataFrame(
        rows, "split string, route_no string, stop_id string, hour_index bigint, date date, f double, y_board double, y_alight double"
    )
    windows = features.sequence_windows(df, KEYS, features=["f"], length=4)
    scores = features.demand_scores(features.model_input(windows, ["f"]))
    errors = {r["split"]: r for r in features.demand_errors(scores).collect()}
    assert errors["test"]["mae_board"] < 0.1 and errors["test"]["mae_alight"] < 0.1
    assert errors["test"]["mse_board"] < errors["test"]["variance_board"]


def test_every_stop_has_its_own_level(spark):
    """Two hundred stops that differ in nothing but their level."""
    rows = [(split, "7", f"s{s}", start + i, D, 1.0, float(s), 3.0 * s)
            for split, start in (("train", 0), ("test", 5000)) for s in range(200) for i in range(6)]
    df = spark.createDataFrame(
        rows, "split string, route_no string, stop_id string, hour_index bigint, date date, f double, y_board double, y_alight double"
    )
    windows = features.sequence_windows(df, KEYS, features=["f"], length=4)
    scores = features.demand_scores(features.model_input(windows, ["f"]))
    worst = scores.where("split = 'test'").agg(F.max(F.abs(F.col("yhat_alight") - F.col("y_alight")))).first()[0]
    assert worst < 1e-6


def test_absolute_fit_beats_squares_on_outliers(spark):
    """A few huge values pull the squares away; the absolute fit keeps to the many."""
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(400).select(
        F.when(F.col("id") % 4 == 0, F.lit("val")).otherwise(F.lit("train")).alias("split"),
        array_to_vector(F.array((F.col("id") % 20).cast("double"))).alias("x"),
        (3.0 * (F.col("id") % 20) + F.when(F.col("id") % 17 == 1, F.lit(900.0)).otherwise(F.lit(0.0))).alias("y_board"),
        F.lit(0.0).alias("level_y_board"),
    ).withColumn("gap_y_board", F.col("y_board"))
    train, validation = (rows.where(F.col("split") == s).cache() for s in ("train", "val"))
    found = features.fit_absolute(train, validation, "y_board", rounds=20, patience=3)
    assert found.error == min(found.errors) < 0.8 * found.errors[0]
    assert 1 < len(found.errors) <= 21
    assert found.model.coefficients[0] == pytest.approx(3.0, abs=0.1)
    # it stops once nothing gets better, keeps the first round if none is, and needs no validation rows
    still = features.fit_absolute(train, validation, "y_board", rounds=0)
    assert still.errors == [found.errors[0]]
    alone = features.fit_absolute(train, validation.limit(0), "y_board", rounds=20, patience=3)
    assert alone.error < alone.errors[0]
    with pytest.raises(ValueError):
        features.demand_scores(rows, loss="cubed")
