import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stopgrid.operators import moves

D = dt.date(2024, 3, 4)


def brute_force(plan):
    """Rank single spare buses and single gaps, then pair equal ranks."""
    days = defaultdict(list)
    for route, date, hour, n, load in plan:
        if n > 0:
            days[route, date].append((hour, n, load))
    out = []
    for (route, date), hours in days.items():
        first, last = min(h for h, _, _ in hours), max(h for h, _, _ in hours)
        spare, gaps = [], []
        for h, n, load in hours:
            if h < first + 3 or h > last - 3:
                continue
            need = max(math.ceil(load / 49.5), 1)
            spare += [(-(n - need), h, u, n) for u in range(max(n - need, 0))]
            gaps += [(-(need - n), h, u) for u in range(max(need - n, 0))]
        for s, g in zip(sorted(spare), sorted(gaps)):
            out.append((route, date, f"{date:%Y%m%d}-{s[1]:02d}-{s[3] - s[2]:02d}", s[1], g[1]))
    return Counter(out)


def table(spark, plan):
    return spark.createDataFrame(plan, "route_no string, date date, hour int, n bigint, l double")


@pytest.mark.parametrize("seed", range(4))
def test_plan_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    plan = [
        (route, D + dt.timedelta(days=d), h, rnd.choice([0, 1, 2, 3, 8, 15]), rnd.choice([0.0, 49.5, 49.6, 200.0, 610.0]))
        for route in ("a", "b") for d in range(6) for h in rnd.sample(range(24), 17)
    ]
    got = moves.reallocation_plan(table(spark, plan)).collect()
    mine = Counter((r["route_no"], r["date"], r["move_bus_id"], r["from_hour"], r["to_hour"]) for r in got)
    assert mine == brute_force(plan) and mine


def test_moves_keep_totals_and_protected_hours(spark):
    plan = [("a", D, h, 12 if h < 12 else 2, 50.0 if h < 12 else 700.0) for h in range(5, 23)]
    df = table(spark, plan)
    after = moves.moved_hours(df).collect()
    assert sum(r["n"] for r in after) == sum(r["n_new"] for r in after)
    assert all(r["n"] == r["n_new"] for r in after if r["hour"] < 8 or r["hour"] > 19)
    made = moves.reallocation_plan(df).collect()
    change = Counter()
    for m in made:
        change[m["from_hour"]] -= 1
        change[m["to_hour"]] += 1
    assert {r["hour"]: r["n_new"] - r["n"] for r in after if r["n_new"] != r["n"]} == {h: c for h, c in change.items() if c}
    # a bus moves once
    assert len({m["move_bus_id"] for m in made}) == len(made)


def test_long_runs_are_whole(spark):
    plan = [("a", D, h, 1, 1.0) for h in (0, 1, 2, 20, 21, 22)] + [("a", D, 8, 5000, 1.0), ("a", D, 9, 1, 49.5 * 4000)]
    made = moves.reallocation_plan(table(spark, plan)).collect()
    numbers = sorted(int(m["move_bus_id"].rsplit("-", 1)[1]) for m in made)
    assert numbers == list(range(5000 - 3999 + 1, 5001))


def test_slots_are_even(spark):
    rows = moves.slot_schedule(table(spark, [("a", D, 7, 3, 0.0)])).orderBy("slot_idx").collect()
    assert [r["departure_us"] for r in rows] == [7 * 3_600_000_000 + k * 1_200_000_000 for k in range(3)]
    assert [r["slot_idx"] for r in rows] == [1, 2, 3]
    text = moves.slot_sentences(moves.slot_schedule(table(spark, [("a", D, 7, 2, 0.0)]))).orderBy("slot_idx").collect()
    assert text[1]["sentence"] == "7시 슬롯 2 — 균등 출발 07:30:00"


def test_reports(spark):
    df = spark.createDataFrame(
        [("a", D, "x", 8, 9), ("a", D, "y", 8, 10), ("a", D, "z", 10, 9)],
        "route_no string, date date, move_bus_id string, from_hour int, to_hour int",
    )
    net = {r["hour"]: (r["moved_out"], r["moved_in"], r["net_change"]) for r in moves.net_change_by_day_hour(df).collect()}
    assert net == {8: (2, 0, -2), 9: (0, 2, 2), 10: (1, 1, 0)}
    hours = moves.moves_by_hour(df).collect()
    assert len(hours) == 24 and sum(r["net_change"] for r in hours) == 0
    assert {r["from_hour"]: (r["to_09"], r["to_10"]) for r in moves.move_matrix(df).collect()} == {8: (1, 1), 10: (1, 0)}
    assert moves.moves_per_day(df).first()["moves"] == 3
    assert len(moves.move_sentences(df, limit=2).collect()) == 2
    assert moves.move_sentences(df).where("move_bus_id = 'x'").first()["sentence"] == "8시 → 9시로 1대 이동 (bus_id=x)"


def test_dates_of_a_plan_are_those_of_its_moves_and_slots(spark):
    from stopgrid.sources import tables

    plan = tables.plan_input(spark, "/root/testdata/sf0.001")
    plan = plan.unionByName(plan.limit(1).withColumn("date", F.lit("2031-01-01").cast("date")).withColumn("n", F.lit(0).cast("bigint")))
    both = moves.available_dates(moves.reallocation_plan(plan), moves.slot_schedule(plan))
    shown = lambda df: sorted(r["date"] for r in df.collect())
    assert shown(moves.plan_dates(plan)) == shown(both) != []
