"""Queries on the reallocation plan and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stopgrid.operators import moves, serving
from stopgrid.plans.registry import plain, query
from stopgrid.plans.twins import day, r, twin
from stopgrid.sources import tables


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moves.reallocation_plan(tables.plan_input(spark, sf_dir))


@query(
    "reallocation_plan",
    twin(f"select route_no, {day()} as date, from_hour, to_hour, move_bus_id from moves", "moves"),
)
def reallocation_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_moves(spark, sf_dir))


SLOTS = """select route_no, date, hour, k + 1 as slot_idx, cast(hour as bigint) * 3600000000
        + cast(round_even(cast(60 as double) / n_new * k * 60e6, 0) as bigint) as departure_us
    from (select *, unnest(range(n_new)) as k from after)"""


@query(
    "slot_schedule",
    twin(f"select route_no, {day()} as date, hour, slot_idx, departure_us from ({SLOTS})", "after"),
)
def slot_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.slot_schedule(tables.plan_input(spark, sf_dir)))


@query(
    "slot_sentences",
    twin(
        f"""select route_no, {day()} as date, hour, slot_idx,
            printf('%d시 슬롯 %d — 균등 출발 %s', hour, slot_idx,
                strftime(cast(date as timestamp) + to_microseconds(departure_us), '%H:%M:%S')) as sentence
        from ({SLOTS})""",
        "after",
    ),
)
def slot_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = moves.slot_sentences(moves.slot_schedule(tables.plan_input(spark, sf_dir)))
    return plain(rows.drop("departure_us"))


@query(
    "reallocation_compare",
    twin(
        f"""select route_no, {day()} as date, hour, n as current_departures, n_new as recommended_departures,
            case when n > 0 then {r('cast(60 as double) / n')} end as current_headway_min,
            case when n_new > 0 then {r('cast(60 as double) / n_new')} end as recommended_headway_min
        from after""",
        "after",
    ),
)
def reallocation_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.reallocation_compare(tables.plan_input(spark, sf_dir)))


ENDS = """select route_no, date, hour, cast(sum(o) as bigint) as moved_out, cast(sum(i) as bigint) as moved_in from (
    select route_no, date, from_hour as hour, 1 as o, 0 as i from moves
    union all select route_no, date, to_hour, 0, 1 from moves) group by 1, 2, 3"""


@query(
    "moves_by_hour",
    twin(
        f"""select d.route_no, {day('d.date')} as date, h.hour, coalesce(e.moved_out, 0) as moved_out,
            coalesce(e.moved_in, 0) as moved_in, coalesce(e.moved_in, 0) - coalesce(e.moved_out, 0) as net_change
        from (select distinct route_no, date from moves) d cross join hours h
        left join ({ENDS}) e on e.route_no = d.route_no and e.date = d.date and e.hour = h.hour""",
        "moves",
        "hours",
    ),
)
def moves_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.moves_by_hour(_moves(spark, sf_dir)))


@query(
    "net_change_by_day_hour",
    twin(
        f"""select route_no, {day()} as date, hour, moved_out, moved_in, moved_in - moved_out as net_change
        from ({ENDS})""",
        "moves",
    ),
)
def net_change_by_day_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.net_change_by_day_hour(_moves(spark, sf_dir)))


MATRIX = ", ".join(f"count(*) filter (where to_hour = {h}) as to_{h:02d}" for h in range(24))


@query(
    "move_matrix",
    twin(
        f"select route_no, {day()} as date, from_hour, {MATRIX} from moves group by route_no, moves.date, from_hour",
        "moves",
    ),
)
def move_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.move_matrix(_moves(spark, sf_dir)))


@query(
    "moves_per_day",
    twin(
        f"""select route_no, {day()} as date, count(*) as moves from moves
        where moves.date between date '2024-01-08' and date '2024-01-14' group by route_no, moves.date""",
        "moves",
    ),
)
def moves_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.moves_per_day(serving.day_window(_moves(spark, sf_dir), "2024-01-08", 7)))


@query(
    "slots_per_hour",
    twin(
        f"""select route_no, {day()} as date, hour, count(distinct slot_idx) as slots from ({SLOTS}) s
        group by route_no, s.date, hour""",
        "after",
    ),
)
def slots_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.slots_per_hour(moves.slot_schedule(tables.plan_input(spark, sf_dir))))


@query(
    "available_dates",
    twin(
        f"""select {day()} as date from (select date from moves union select date from after where n_new > 0)""",
        "after",
    ),
)
def available_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(moves.plan_dates(tables.plan_input(spark, sf_dir)))


@query(
    "move_sentences",
    twin(
        f"""select route_no, {day()} as date, move_bus_id,
            printf('%d시 → %d시로 1대 이동 (bus_id=%s)', from_hour, to_hour, move_bus_id) as sentence
        from moves""",
        "moves",
    ),
)
def move_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = moves.move_sentences(_moves(spark, sf_dir))
    return plain(rows.select("route_no", "date", "move_bus_id", "sentence"))


@query(
    "move_sentences_first",
    twin(
        f"""select route_no, {day()} as date, move_bus_id,
            printf('%d시 → %d시로 1대 이동 (bus_id=%s)', from_hour, to_hour, move_bus_id) as sentence
        from moves order by moves.date, route_no, move_bus_id limit 10""",
        "moves",
    ),
)
def move_sentences_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's first ten moves."""
    rows = moves.move_sentences(_moves(spark, sf_dir), limit=10)
    return plain(rows.select("route_no", "date", "move_bus_id", "sentence"))
