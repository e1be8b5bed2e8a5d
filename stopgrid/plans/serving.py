"""Queries on the fact table: gold aggregates, summaries, forecast, payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import jobs
from stopgrid.operators import serving
from stopgrid.plans.registry import plain, query, six_digits
from stopgrid.plans.twins import day, r, twin
from stopgrid.session import shared_path
from stopgrid.sources import tables

FORECAST_START = "2024-02-01"

SUMMARY = f"""select route_no, {day()} as date, hour, cast(sum(ops) as bigint) as current_departures,
    {r('max(case when ops > 0 then board / ops end)')} as max_board_per_bus,
    case when sum(ops) > 0 then {r('cast(60 as double) / sum(ops)')} end as headway_min,
    case when max(case when ops > 0 then board / ops end) > 49.5 then 1 else 0 end as is_crowded
from dsh group by route_no, dsh.date, hour"""


@query("summary_by_hour", twin(SUMMARY, "dsh"))
def summary_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.summary_by_hour(tables.daily_stop_hour(spark, sf_dir)))


STOP_DETAIL = f"""select route_no, {day()} as date, stop_seq, hour, cast(sum(ops) as bigint) as pass_buses,
    {r('sum(board)')} as board_total, {r('sum(alight)')} as alight_total,
    {r('max(link_distance_m)')} as link_distance_m, min(stop_name) as stop_name,
    case when sum(ops) > 0 then {r('sum(board) / sum(ops)')} end as board_per_bus
from dsh group by route_no, dsh.date, stop_seq, hour"""


@query("stop_detail_by_hour", twin(STOP_DETAIL, "dsh"))
def stop_detail_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.stop_detail_by_hour(tables.daily_stop_hour(spark, sf_dir)))


WEEKDAY = """select route_no, dayofweek(date) + 1 as dow, hour, avg(board) as avg_board, avg(ops) as avg_dep,
    avg(case when ops > 0 then board / ops end) as avg_board_per_bus
from dsh group by 1, 2, 3"""


@query(
    "weekday_hour_avg",
    twin(
        f"""select route_no, cast(dow as int) as dow, hour, {r('avg_board')} as avg_board,
            {r('avg_dep')} as avg_dep, {r('avg_board_per_bus')} as avg_board_per_bus from ({WEEKDAY})""",
        "dsh",
    ),
)
def weekday_hour_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.weekday_hour_avg(tables.daily_stop_hour(spark, sf_dir)))


GRID = f"""select r.route_no, cast(d.range as date) as date, h.hour
from (select distinct route_no from passes) r
cross join range(date '{FORECAST_START}', date '{FORECAST_START}' + interval 7 day, interval 1 day) d
cross join hours h"""


FORECAST = f"""select g.route_no, {day('g.date')} as date, g.hour,
    {r('coalesce(avg_dep, 0)')} as forecast_departures,
    {r('coalesce(avg_board_per_bus, 0)')} as forecast_board_per_bus,
    case when avg_dep > 0 then {r('cast(60 as double) / avg_dep')} end as forecast_headway_min,
    case when avg_board_per_bus > 49.5 then 1 else 0 end as crowded_flag
from ({GRID}) g left join ({WEEKDAY}) a
    on a.route_no = g.route_no and a.dow = dayofweek(g.date) + 1 and a.hour = g.hour"""


@query("forecast_weekday", twin(FORECAST, "dsh", "hours"))
def forecast_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.forecast_weekday(tables.daily_stop_hour(spark, sf_dir), FORECAST_START))


CORRECTED = """select route_no, date, hour, stop_id, board, case when date >= date '2024-01-15' then ops + 1 else ops end as ops from dsh"""


@query(
    "weekday_states_refresh",
    twin(
        f"""select route_no, cast(dayofweek(date) + 1 as int) as dow, hour, {r('avg(board)')} as avg_board, {r('avg(ops)')} as avg_dep,
            {r('avg(board / ops)')} as avg_board_per_bus
        from ({CORRECTED}) group by 1, 2, 3""",
        "dsh",
    ),
)
def weekday_states_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, of which the second corrects the last date of the first."""
    states, totals = shared_path(spark, "weekday-states"), shared_path(spark, "weekday-totals")
    for batch in (tables.prev_batch(spark, sf_dir), tables.new_batch(spark, sf_dir)):
        dates = [row[0] for row in batch.select("date").distinct().collect()]
        jobs.refresh_weekdays(batch, dates, states, totals)
    return plain(jobs.read_weekdays(spark, totals))


@query(
    "calendar_grid",
    twin(f"select route_no, {day()} as date, hour from ({GRID})", "passes", "hours"),
)
def calendar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = tables.dim_route_map(spark, sf_dir).select("route_no")
    return plain(serving.forecast_grid(routes, FORECAST_START))


@query(
    "gold_hour_summary",
    twin(
        f"""select route_no, {day()} as date, hour, cast(sum(coalesce(ops, 0)) as bigint) as current_departures
        from grid group by route_no, grid.date, hour""",
        "grid",
    ),
)
def gold_hour_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.hour_departures(tables.ops_hourly(spark, sf_dir)))


@query(
    "gold_stop_detail",
    twin(
        f"""select route_no, {day()} as date, stop_id, stop_seq, hour,
            cast(sum(coalesce(ops, 0)) as bigint) as departures
        from grid group by route_no, grid.date, stop_id, stop_seq, hour""",
        "grid",
    ),
)
def gold_stop_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(serving.stop_departures(tables.ops_hourly(spark, sf_dir)))


@query(
    "payload_summary_json",
    twin(
        f"""select route_no, date, to_json({{'ok': true, 'action': 'summary', 'route_no': route_no, 'date': date,
            'hours': list({{'hour': hour, 'current_departures': current_departures, 'headway_min': headway_min,
                'max_board_per_bus': max_board_per_bus, 'is_crowded': is_crowded}} order by hour)}})::varchar as payload
        from ({SUMMARY}) group by route_no, date""",
        "dsh",
    ),
)
def payload_summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serving.summary_by_hour(tables.daily_stop_hour(spark, sf_dir))
    rows = rows.withColumns({c: six_digits(F.col(c)) for c in ("headway_min", "max_board_per_bus")})
    fields = ["current_departures", "headway_min", "max_board_per_bus", "is_crowded"]
    return plain(serving.hour_payloads(rows, "summary", ["route_no", "date"], fields))


@query(
    "payload_forecast_json",
    twin(f"select *, 'forecast' as action, '{FORECAST_START}' as start, 7 as days from ({FORECAST})", "dsh", "hours"),
)
def payload_forecast_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast documents, read back into rows."""
    payloads = serving.forecast_payloads(tables.daily_stop_hour(spark, sf_dir), FORECAST_START)
    document = F.from_json(
        "payload",
        "action string, start string, days int, hours array<struct<date string, hour int, "
        "forecast_departures double, forecast_board_per_bus double, forecast_headway_min double, crowded_flag int>>",
    )
    rows = payloads.select("route_no", document.alias("d"))
    return plain(rows.select("route_no", "d.action", "d.start", "d.days", F.inline("d.hours")))


@query("payload_stop_detail_json", twin(STOP_DETAIL, "dsh"))
def payload_stop_detail_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop detail documents, read back into rows."""
    payloads = serving.stop_detail_payloads(tables.daily_stop_hour(spark, sf_dir))
    document = F.from_json(
        "payload",
        "route_no string, date string, stop_seq int, hours array<struct<hour int, pass_buses bigint, "
        "board_total double, alight_total double, board_per_bus double, link_distance_m double, stop_name string>>",
    )
    rows = payloads.select(document.alias("d"))
    return plain(rows.select("d.route_no", "d.date", "d.stop_seq", F.inline("d.hours")))


@query(
    "date_range_filter",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour, ops from dsh
        where dsh.date between date '2024-01-10' and date '2024-01-20'""",
        "dsh",
    ),
)
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serving.date_range(tables.daily_stop_hour(spark, sf_dir), "2024-01-10", "2024-01-20")
    return plain(rows.select("route_no", "date", "stop_id", "hour", "ops"))
