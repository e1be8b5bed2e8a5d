"""Route summaries, stop details, weekday averages and the forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators.reshape import calendar
from stopgrid.session import stored


def select_rows(
    df: DataFrame,
    route_no: str | None = None,
    date: str | dt.date | None = None,
    stop_seq: int | None = None,
) -> DataFrame:
    """Equality filters on whichever arguments are given."""
    for name, value in (("route_no", route_no), ("date", date), ("stop_seq", stop_seq)):
        if value is not None:
            literal = F.lit(value).cast("date") if name == "date" else F.lit(value)
            df = df.where(F.col(name) == literal)
    return df


def date_range(df: DataFrame, first: str | dt.date, last: str | dt.date, name: str = "date") -> DataFrame:
    """Inclusive date window."""
    return df.where(F.col(name).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def day_window(df: DataFrame, start: str | dt.date, days: int = S.FORECAST_DAYS) -> DataFrame:
    """The `days` dates from `start`."""
    first = F.lit(start).cast("date")
    return df.where(F.col("date").between(first, F.date_add(first, days - 1)))


# -- gold aggregates --------------------------------------------------------
def stop_departures(ops: DataFrame) -> DataFrame:
    return ops.groupBy("route_no", "date", "stop_id", "stop_seq", "hour").agg(
        F.sum("ops").alias("departures")
    )


def hour_departures(ops: DataFrame) -> DataFrame:
    return ops.groupBy("route_no", "date", "hour").agg(F.sum("ops").alias("current_departures"))


def gold(ops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Departures per hour and per stop; the long table is read once.

    The stop table is written to the shared folder and the hour table adds it up.
    """
    stops = stored(stop_departures(ops), "gold-stops")
    hours = stops.groupBy("route_no", "date", "hour").agg(F.sum("departures").alias("current_departures"))
    return hours, stops


# -- queries on the fact table ----------------------------------------------
def summary_by_hour(fact: DataFrame, route_no: str | None = None, date=None) -> DataFrame:
    """Departures, headway and highest boardings per bus, per route, date and hour."""
    per_bus = F.when(F.col("ops") > 0, F.col("board") / F.col("ops"))
    grouped = (
        select_rows(fact, route_no, date)
        .groupBy("route_no", "date", "hour")
        .agg(F.sum("ops").alias("current_departures"), F.max(per_bus).alias("max_board_per_bus"))
    )
    return grouped.withColumn("headway_min", C.minutes_between("current_departures")).withColumn(
        "is_crowded", C.is_crowded("max_board_per_bus")
    )


def stop_detail_by_hour(fact: DataFrame, route_no: str | None = None, date=None, stop_seq=None) -> DataFrame:
    """Buses, demand, distance and name per route, date, stop sequence and hour."""
    grouped = (
        select_rows(fact, route_no, date, stop_seq)
        .groupBy("route_no", "date", "stop_seq", "hour")
        .agg(
            F.sum("ops").alias("pass_buses"),
            F.sum("board").alias("board_total"),
            F.sum("alight").alias("alight_total"),
            F.max("link_distance_m").alias("link_distance_m"),
            F.min("stop_name").alias("stop_name"),
        )
    )
    return grouped.withColumn(
        "board_per_bus",
        F.when(F.col("pass_buses") > 0, F.col("board_total") / F.col("pass_buses")),
    )


MEANS = {"avg_board": "board", "avg_dep": "ops", "avg_board_per_bus": "per_bus"}


def weekday_hour_avg(fact: DataFrame) -> DataFrame:
    """Averages over all stop-hour rows of a weekday (Sunday = 1) and hour."""
    rows = fact.withColumns({"dow": F.dayofweek("date"), "per_bus": _per_bus()})
    return rows.groupBy("route_no", "dow", "hour").agg(*[F.avg(v).alias(n) for n, v in MEANS.items()])


def _per_bus() -> Column:
    return F.when(F.col("ops") > 0, F.col("board") / F.col("ops"))


def weekday_states(fact: DataFrame) -> DataFrame:
    """Sum and count of each mean's values per route, date and hour: what a date adds to its weekday."""
    rows = fact.withColumns({"dow": F.dayofweek("date"), "per_bus": _per_bus()})
    parts = [f(v).alias(f"{name}_{v}") for v in MEANS.values() for name, f in (("sum", F.sum), ("count", F.count))]
    return rows.groupBy("route_no", "dow", "date", "hour").agg(*parts)


def merged_states(states: DataFrame) -> DataFrame:
    """States of all dates of a weekday as one."""
    parts = [F.sum(f"{name}_{v}").alias(f"{name}_{v}") for v in MEANS.values() for name in ("sum", "count")]
    return states.groupBy("route_no", "dow", "hour").agg(*parts)


def averages_of(states: DataFrame) -> DataFrame:
    """The averages that merged states stand for, as `weekday_hour_avg` gives them."""
    means = [(F.col(f"sum_{v}") / F.nullif(F.col(f"count_{v}"), F.lit(0))).alias(n) for n, v in MEANS.items()]
    return states.select("route_no", "dow", "hour", *means)


def forecast_grid(routes: DataFrame, start: str | dt.date, days: int = S.FORECAST_DAYS) -> DataFrame:
    """Every route for `days` dates from `start` and 24 hours."""
    return calendar(routes, F.lit(start).cast("date"), days)


def forecast_weekday(fact: DataFrame, start: str | dt.date, days: int = S.FORECAST_DAYS) -> DataFrame:
    """Weekday averages laid over the coming days; an hour without history is 0.

    The averages are one row per route with a 7 x 24 table, so that the calendar
    grows out of that row and neither a route list nor a join is needed.
    """
    return forecast_from(weekday_hour_avg(fact), start, days)


def forecast_from(averages: DataFrame, start: str | dt.date, days: int = S.FORECAST_DAYS) -> DataFrame:
    """The forecast of given weekday averages."""
    key = F.col("dow") * 24 + F.col("hour")
    tables = averages.groupBy("route_no").agg(
        F.map_from_entries(
            F.collect_list(F.struct(key, F.struct("avg_dep", "avg_board_per_bus")))
        ).alias("stats")
    )
    grid = forecast_grid(tables, start, days)
    stats = F.try_element_at("stats", F.dayofweek("date") * 24 + F.col("hour"))
    rows = grid.select(
        "route_no",
        "date",
        "hour",
        F.coalesce(stats["avg_dep"], F.lit(0.0)).alias("forecast_departures"),
        F.coalesce(stats["avg_board_per_bus"], F.lit(0.0)).alias("forecast_board_per_bus"),
    )
    return rows.withColumn(
        "forecast_headway_min", C.minutes_between("forecast_departures")
    ).withColumn("crowded_flag", C.is_crowded("forecast_board_per_bus"))


# -- payloads ---------------------------------------------------------------
def hour_payloads(rows: DataFrame, action: str, keys: list[str], fields: list[str]) -> DataFrame:
    """One JSON document per key with its hour rows in order; nulls are kept."""
    hours = F.sort_array(F.collect_list(F.struct("hour", *fields))).alias("hours")
    grouped = rows.groupBy(*keys).agg(hours)
    names = [F.col(k).cast("string").alias(k) if k == "date" else F.col(k) for k in keys]
    body = F.struct(F.lit(True).alias("ok"), F.lit(action).alias("action"), *names, "hours")
    return grouped.select(
        *keys, F.to_json(body, {"ignoreNullFields": "false"}).alias("payload")
    )


def summary_payloads(fact: DataFrame, route_no: str | None = None, date=None) -> DataFrame:
    fields = ["current_departures", "headway_min", "max_board_per_bus", "is_crowded"]
    return hour_payloads(summary_by_hour(fact, route_no, date), "summary", ["route_no", "date"], fields)


def stop_detail_payloads(fact: DataFrame, route_no: str | None = None, date=None, stop_seq=None) -> DataFrame:
    fields = ["pass_buses", "board_total", "alight_total", "board_per_bus", "link_distance_m", "stop_name"]
    rows = stop_detail_by_hour(fact, route_no, date, stop_seq)
    return hour_payloads(rows, "stop_detail", ["route_no", "date", "stop_seq"], fields)


def forecast_payloads(fact: DataFrame, start: str | dt.date, days: int = S.FORECAST_DAYS) -> DataFrame:
    """One JSON document per route with all hours of the coming days in order."""
    rows = forecast_weekday(fact, start, days)
    hour = F.struct(
        F.col("date").cast("string").alias("date"),
        "hour",
        "forecast_departures",
        "forecast_headway_min",
        "forecast_board_per_bus",
        "crowded_flag",
    )
    body = F.struct(
        F.lit(True).alias("ok"),
        F.lit("forecast").alias("action"),
        "route_no",
        F.lit(str(start)).alias("start"),
        F.lit(days).alias("days"),
        "hours",
    )
    grouped = rows.groupBy("route_no").agg(F.sort_array(F.collect_list(hour)).alias("hours"))
    return grouped.select("route_no", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))
