"""Canonical tables derived from the `events` table.

An event is one bus passing a stop: the event type is the route, the user's
number modulo 12 the stop, the value the boardings and the number in `props` the
alightings. Every function returns a lazy DataFrame over the whole table.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C

PREV_UNTIL = "2024-01-16"
NEW_FROM = "2024-01-15"
SPLITS = {
    "train": ("0001-01-01", "2024-01-19"),
    "val": ("2024-01-20", "2024-01-21"),
    "test": ("2024-01-22", "9999-12-31"),
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("route_no"),
        F.col("ts").cast("date").alias("date"),
        (F.col("user_id") % 12 + 1).cast("int").alias("stop_seq"),
        F.hour("ts").cast("int").alias("hour"),
        F.col("value").cast("decimal(18,2)").alias("board"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("alight"),
    )


def stop_id(seq: str = "stop_seq") -> Column:
    return F.concat(F.lit("S"), F.col(seq).cast("string"))


def stop_name(seq: str = "stop_seq") -> Column:
    return F.concat(F.lit("Stop "), F.col(seq).cast("string"))


def link_distance(seq: str = "stop_seq") -> Column:
    return F.lit(2000.0) + F.lit(740.0) * (F.col(seq) - 1)


def daily_stop_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed fact table: one row per route, date, stop and hour."""
    return (
        passes(spark, sf_dir)
        .groupBy("route_no", "date", "stop_seq", "hour")
        .agg(
            F.count("*").alias("ops"),
            F.sum("board").cast("double").alias("board"),
            F.sum("alight").cast("double").alias("alight"),
        )
        .withColumns(
            {"stop_id": stop_id(), "stop_name": stop_name(), "link_distance_m": link_distance()}
        )
    )


def route_key(route: Column | str) -> Column:
    """Key of a route in the operations data."""
    c = F.col(route) if isinstance(route, str) else route
    return F.concat(F.lit("R-"), c)


def ops_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns ops_00 .. ops_23, null where an hour has no bus; one shuffle."""
    counts = [
        F.sum(F.when(F.col("hour") == h, F.lit(1))).cast("string").alias(f"ops_{h:02d}")
        for h in range(24)
    ]
    rows = (
        passes(spark, sf_dir)
        .groupBy("route_no", "date", "stop_seq")
        .agg(*counts, F.count("*").cast("string").alias("ops_day"))
    )
    return rows.select(
        C.compact_date("date").alias("date"),
        route_key("route_no").alias("route_key"),
        stop_id().alias("stop_id"),
        F.col("stop_seq").cast("string").alias("stop_seq"),
        "route_no",
        "ops_day",
        *[f"ops_{h:02d}" for h in range(24)],
    )


def ops_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full 24-hour grid of counts for every route, date and stop that occurs."""
    wide = ops_wide(spark, sf_dir)
    entries = [
        F.struct(
            F.lit(h).alias("hour"),
            F.coalesce(F.col(f"ops_{h:02d}").cast("bigint"), F.lit(0).cast("bigint")).alias("ops"),
        )
        for h in range(24)
    ]
    return wide.select(
        C.parse_date("date").alias("date"),
        "route_no",
        F.col("route_key").alias("rte_id"),
        "stop_id",
        F.col("stop_seq").cast("int").alias("stop_seq"),
        F.inline(F.array(*entries)),
    )


def demand_daily_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number boardings and alightings per route, date and stop."""
    return (
        passes(spark, sf_dir)
        .groupBy("route_no", "date", "stop_seq")
        .agg(
            F.floor(F.sum("board")).cast("bigint").alias("board_total"),
            F.sum("alight").cast("bigint").alias("alight_total"),
        )
        .select(
            "date",
            route_key("route_no").alias("rte_id"),
            "route_no",
            stop_id().alias("stop_id"),
            stop_name().alias("stop_name"),
            "board_total",
            "alight_total",
            F.date_add("date", 3).alias("reg_ymd"),
        )
    )


def demand_monthly_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per month, route, stop and hour; hours without events have no row."""
    return (
        passes(spark, sf_dir)
        .groupBy(F.trunc("date", "MM").alias("month"), "route_no", "stop_seq", "hour")
        .agg(
            F.floor(F.sum("board")).cast("bigint").alias("board_total"),
            F.sum("alight").cast("bigint").alias("alight_total"),
        )
        .select(
            C.month_of("month").alias("use_ym"),
            "route_no",
            stop_id().alias("stop_id"),
            "hour",
            stop_name().alias("stop_name"),
            "board_total",
            "alight_total",
            F.lit("2024-02-03").cast("date").alias("reg_ymd"),
        )
    )


def dim_route_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .select(F.col("event_type").alias("route_no"))
        .distinct()
        .select(
            route_key("route_no").alias("route_key"),
            route_key("route_no").alias("rte_id"),
            "route_no",
        )
    )


def dim_stop_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances with gaps: null at sequence 7, 0 at 5, unknown ids at 4, 8 and 12."""
    stops = passes(spark, sf_dir).select("route_no", "stop_seq").distinct()
    seq = F.col("stop_seq")
    return stops.select(
        route_key("route_no").alias("route_key"),
        "route_no",
        F.when(seq.isin(4, 8, 12), F.concat(F.lit("X"), seq.cast("string")))
        .otherwise(stop_id())
        .alias("stop_id"),
        "stop_seq",
        F.when(seq == 5, F.lit(0.0)).when(seq != 7, link_distance()).alias("link_distance_m"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = daily_stop_hour(spark, sf_dir)
    buses = F.col("ops") * 1.25
    return fact.select(
        "route_no",
        "date",
        "hour",
        "stop_id",
        "stop_seq",
        "stop_name",
        buses.alias("pass_buses"),
        F.col("board").alias("pred_board"),
        F.col("alight").alias("pred_alight"),
        (F.col("board") / buses).alias("board_per_bus"),
        (F.col("alight") / buses).alias("alight_per_bus"),
        F.lit(0.0).alias("onboard_per_bus"),
    )


def plan_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures n and load l per route, date and hour."""
    return (
        passes(spark, sf_dir)
        .groupBy("route_no", "date", "hour")
        .agg(F.count("*").alias("n"), F.sum("board").cast("double").alias("l"))
    )


def prev_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_stop_hour(spark, sf_dir).where(F.col("date") < F.lit(PREV_UNTIL).cast("date"))


def new_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        daily_stop_hour(spark, sf_dir)
        .where(F.col("date") >= F.lit(NEW_FROM).cast("date"))
        .withColumn("ops", F.col("ops") + 1)
    )


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs per date: NO_DATA first, then OK or a skip on odd days and ERROR on even days."""
    dates = events(spark, sf_dir).select(F.col("ts").cast("date").alias("target_date")).distinct()
    runs = dates.withColumn("run", F.explode(F.array(F.lit(0), F.lit(1))))
    day = F.day("target_date") % 4
    status = (
        F.when(F.col("run") == 0, F.lit("NO_DATA"))
        .when(day == 1, F.lit("OK"))
        .when(day == 3, F.lit("SKIPPED_SAME_DATE"))
        .otherwise(F.lit("ERROR"))
    )
    return runs.select(
        (F.unix_date("target_date").cast("bigint") * 2 + F.col("run")).alias("id"),
        F.lit(S.FACT_JOB).alias("job_name"),
        "target_date",
        status.alias("status"),
    )
