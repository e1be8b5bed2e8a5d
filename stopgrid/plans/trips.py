"""Queries on schedules, allocation and prediction output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import jobs
from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators import trips
from stopgrid.plans.registry import plain, query
from stopgrid.plans.twins import day, r, twin
from stopgrid.session import shared_path
from stopgrid.sources import files, tables


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.dim_stop_link(spark, sf_dir)


@query(
    "link_profile",
    twin(
        f"""select distinct p.route_no, {day('p.date')} as date, p.stop_seq, {r('l.d')} as link_distance_m,
            {r('l.mean')} as mean_nonzero
        from preds p join link_clean l on l.route_no = p.route_no and l.stop_seq = p.stop_seq""",
        "preds",
        "link_clean",
    ),
)
def link_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(trips.link_profile(tables.predictions(spark, sf_dir), _links(spark, sf_dir)))


@query(
    "stop_profile",
    twin(
        f"""select route_no, {day()} as date, stop_seq, stop_id, stop_name,
            {r('link_distance_m')} as link_distance_m, 'links' as link_source from profile""",
        "profile",
    ),
)
def stop_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(trips.stop_profile(tables.predictions(spark, sf_dir), _links(spark, sf_dir)))


@query(
    "expand_departures",
    twin(
        f"""select route_no, {day()} as date, bus_id, hour as departure_hour, {r('headway_min')} as headway_min,
            departure_us from deps""",
        "deps",
    ),
)
def expand_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(trips.expand_departures(tables.predictions(spark, sf_dir)))


@query(
    "propagate_arrivals",
    twin(
        f"""select route_no, {day()} as date, bus_id, stop_seq, stop_id, stop_name, arrival_us from arrivals""",
        "arrivals",
    ),
)
def propagate_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = tables.predictions(spark, sf_dir)
    profile = trips.stop_profile(predictions, _links(spark, sf_dir))
    return plain(trips.propagate_arrivals(trips.expand_departures(predictions), profile))


@query(
    "schedule",
    twin(
        """select route_no, bus_id, strftime(date, '%Y-%m-%d') as date, stop_seq, stop_id, stop_name,
            strftime(cast(date as timestamp) + to_microseconds(arrival_us), '%Y-%m-%d %H:%M:%S.%f') as arrival_ts,
            cast((arrival_us // 3600000000) % 24 as int) as arrival_hour
        from arrivals""",
        "arrivals",
    ),
)
def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    timetable = trips.schedule(tables.predictions(spark, sf_dir), _links(spark, sf_dir))
    return plain(trips.schedule_table(timetable))


@query(
    "allocation",
    twin(
        f"""select route_no, bus_id, {day()} as date, stop_seq, stop_id, arrival_us, buses_in_hour,
            {r('board_total')} as board_total, {r('alight_total')} as alight_total,
            {r('board_per_bus')} as board_per_bus, {r('alight_per_bus')} as alight_per_bus,
            {r('onboard_before')} as onboard_before, {r('onboard_after')} as onboard_after,
            case when onboard_after <= 33 then 'free' when onboard_after <= 49.5 then 'normal'
                else 'crowded' end as crowding
        from (
            select *, greatest(onboard_after - (board_per_bus - alight_per_bus), 0) as onboard_before from (
                select a.*, s.n as buses_in_hour, s.board_total, s.alight_total, s.board_per_bus, s.alight_per_bus,
                    greatest(sum(s.board_per_bus - s.alight_per_bus) over (
                        partition by a.route_no, a.bus_id order by a.stop_seq
                        rows between unbounded preceding and current row), 0) as onboard_after
                from arrivals a join shares s on s.route_no = a.route_no and s.date = a.date
                    and s.stop_seq = a.stop_seq and s.bucket = a.arrival_us // 3600000000))""",
        "arrivals",
        "shares",
    ),
)
def allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = tables.predictions(spark, sf_dir)
    demand = trips.demand_totals(predictions, ["pred_board"], ["pred_alight"])
    rows = trips.allocation(predictions, demand, _links(spark, sf_dir))
    return plain(
        rows.select(
            "route_no", "bus_id", "date", "stop_seq", "stop_id", "arrival_us", "buses_in_hour",
            "board_total", "alight_total", "board_per_bus", "alight_per_bus",
            "onboard_before", "onboard_after", "crowding",
        )
    )


REPORT = S.struct(
    "bus_id string, date date, stop_seq int, stop_id string, board_total double, board_per_bus double, "
    "approx_demand double, link_source string"
)


@query(
    "sink_csv_allocation",
    twin(
        f"""select a.route_no as route, a.bus_id, {day('a.date')} as date, a.stop_seq, a.stop_id,
            {r('s.board_total')} as board_total, {r('s.board_per_bus')} as board_per_bus,
            {r('s.board_total')} as approx_demand, 'LINK_CSV' as link_source
        from arrivals a join shares s on s.route_no = a.route_no and s.date = a.date
            and s.stop_seq = a.stop_seq and s.bucket = a.arrival_us // 3600000000""",
        "arrivals",
        "shares",
    ),
)
def sink_csv_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allocation report written as files and read again by its names there."""
    paths = [shared_path(spark, n) for n in ("schedule-csv", "allocation-csv")]
    jobs.export_schedule(tables.predictions(spark, sf_dir), _links(spark, sf_dir), *paths)
    names = {f.name: S.ALLOCATION_NAMES[f.name] for f in REPORT}
    schema = S.struct("route string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REPORT))
    return plain(files.read_csv_typed(spark, paths[1], {"route": "route", **names}, schema))


@query(
    "demand_totals",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour,
            {r('greatest((board_per_bus - 20) * pass_buses, 0)')} as board_total,
            {r('greatest(pred_alight - 30, 0)')} as alight_total
        from preds""",
        "preds",
    ),
)
def demand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.predictions(spark, sf_dir).select(
        "route_no",
        "date",
        "stop_id",
        "hour",
        "pass_buses",
        (F.col("board_per_bus") - 20).alias("버스당_승차"),
        (F.col("pred_alight") - 30).alias("하차인원"),
    )
    totals = trips.demand_totals(rows)
    return plain(totals.select("route_no", "date", "stop_id", "hour", "board_total", "alight_total"))


def _along(partition: str) -> str:
    return f"(partition by {partition} order by stop_seq rows between unbounded preceding and current row)"


@query(
    "onboard_by_bus",
    twin(
        f"""select route_no, bus_id, stop_seq, {r('onboard_after')} as onboard_after,
            {r('greatest(onboard_after - (board_per_bus - alight_per_bus), 0)')} as onboard_before
        from (select *, printf('%s-%02d-%02d', strftime(date, '%Y%m%d'), hour, 1) as bus_id,
                greatest(sum(board_per_bus - alight_per_bus) over {_along('route_no, date, hour')}, 0) as onboard_after
            from preds)""",
        "preds",
    ),
)
def onboard_by_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.predictions(spark, sf_dir).withColumn("bus_id", trips.bus_id("date", "hour", F.lit(1)))
    return plain(
        trips.onboard_by_bus(rows).select("route_no", "bus_id", "stop_seq", "onboard_after", "onboard_before")
    )


@query(
    "onboard_by_hour",
    twin(
        f"""select route_no, {day()} as date, hour, stop_id,
            {r(f"greatest(sum(board_per_bus - alight_per_bus) over {_along('route_no, preds.date, hour')}, 0)")} as onboard_per_bus
        from preds""",
        "preds",
    ),
)
def onboard_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips.onboard_by_hour(tables.predictions(spark, sf_dir))
    return plain(rows.select("route_no", "date", "hour", "stop_id", "onboard_per_bus"))


def _scores(fact: DataFrame) -> DataFrame:
    return fact.select(
        "route_no",
        "stop_id",
        "date",
        "hour",
        (F.col("board") * 1.1 - 20).alias("yhat_board"),
        (F.col("alight") * 0.9 - 15).alias("yhat_alight"),
    )


YHAT_BOARD = "(board * cast(1.1 as double) - 20)"
YHAT_ALIGHT = "(alight * cast(0.9 as double) - 15)"


@query(
    "predictions_with_meta",
    twin(
        f"""select route_no, {day()} as date, hour, stop_id, stop_seq, stop_name, cast(ops as double) as pass_buses,
            {r(YHAT_BOARD)} as yhat_board, {r(YHAT_ALIGHT)} as yhat_alight from dsh""",
        "dsh",
    ),
)
def predictions_with_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = tables.daily_stop_hour(spark, sf_dir)
    return plain(trips.predictions_with_meta(_scores(fact), fact))


@query(
    "predictions_output",
    twin(
        f"""select route_no, {day()} as date, hour, stop_id, stop_seq, stop_name, pass_buses,
            {r('b')} as pred_board, {r('a')} as pred_alight,
            {r('b / pass_buses')} as board_per_bus, {r('a / pass_buses')} as alight_per_bus,
            {r(f"greatest(sum((b - a) / pass_buses) over {_along('route_no, x.date, hour')}, 0)")} as onboard_per_bus
        from (select *, cast(ops as double) as pass_buses, greatest({YHAT_BOARD}, 0) as b,
            greatest({YHAT_ALIGHT}, 0) as a from dsh) x""",
        "dsh",
    ),
)
def predictions_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = tables.daily_stop_hour(spark, sf_dir)
    return plain(trips.predictions_output(_scores(fact), fact))


@query(
    "crowding_label",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour,
            case when board / ops <= 33 then 'free' when board / ops <= 49.5 then 'normal' else 'crowded' end as crowding
        from dsh""",
        "dsh",
    ),
)
def crowding_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = tables.daily_stop_hour(spark, sf_dir)
    return plain(
        fact.select(
            "route_no", "date", "stop_id", "hour",
            C.crowding(F.col("board") / F.col("ops")).alias("crowding"),
        )
    )
