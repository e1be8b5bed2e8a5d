"""Link profiles, departures, arrival propagation, schedule and allocation.

Times inside a service day are whole microseconds since its midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators.reshape import explode_chunks, explode_range, range_chunks
from stopgrid.session import stored

ROUTE_DAY = ["route_no", "date"]
TRIP = ["route_no", "bus_id"]
BUCKET = ["route_no", "date", "stop_seq", "hour_bucket"]


# -- links ------------------------------------------------------------------
def route_links(links: DataFrame) -> DataFrame:
    """Distance per (route, sequence) and the route's mean of the usable ones.

    The mean leaves out sequence 1, nulls and zeros. Sequence 1 has distance 0;
    a missing, zero or negative distance elsewhere takes the mean. The window sees
    one row per stop of a route.
    """
    per_seq = (
        links.where(F.col("stop_seq").isNotNull())
        .groupBy("route_no", "stop_seq")
        .agg(F.avg("link_distance_m").alias("d"))
    )
    usable = F.when((F.col("stop_seq") != 1) & (F.col("d") != 0), F.col("d"))
    mean = F.avg(usable).over(Window.partitionBy("route_no"))
    distance = (
        F.when(F.col("stop_seq") == 1, F.lit(0.0))
        .when(F.col("d") > 0, F.col("d"))
        .otherwise(F.col("mean_nonzero"))
    )
    return per_seq.withColumn("mean_nonzero", mean).select(
        "route_no", "stop_seq", distance.alias("link_distance_m"), "mean_nonzero"
    )


def link_profile(predictions: DataFrame, links: DataFrame) -> DataFrame:
    """Link rows of the sequences that occur on each route and date."""
    seqs = predictions.select(*ROUTE_DAY, "stop_seq").distinct()
    return seqs.join(route_links(links), ["route_no", "stop_seq"])


def stop_profile(predictions: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Ordered stops of each route and date with one id, name and distance each.

    A sequence without a link row takes the route's mean, a route without links
    300 m per link. Of several stops at one sequence the lowest id is kept, a missing
    one only where there is no other. Rows without a sequence have no place on the
    route and are left out; `merge.key_violations` reports them.
    """
    lowest = F.min(F.struct(F.col("stop_id").isNull().alias("none"), "stop_id", "stop_name")).alias("_s")
    known = predictions.where(F.col("stop_seq").isNotNull())
    stops = known.groupBy(*ROUTE_DAY, "stop_seq").agg(lowest).select(*ROUTE_DAY, "stop_seq", "_s.stop_id", "_s.stop_name")
    default = F.when(F.col("stop_seq") == 1, F.lit(0.0)).otherwise(F.lit(S.DEFAULT_LINK_M))
    if links is None:
        return stops.withColumn("link_distance_m", default).withColumn("link_source", F.lit("default"))
    table = route_links(links).groupBy("route_no").agg(
        F.map_from_entries(F.collect_list(F.struct("stop_seq", "link_distance_m"))).alias("d"),
        F.max("mean_nonzero").alias("mean"),
    )
    known = F.try_element_at("d", F.col("stop_seq"))
    return stops.join(table, "route_no", "left").select(
        *stops.columns,
        F.coalesce(known, F.col("mean"), default).alias("link_distance_m"),
        F.when(F.col("d").isNotNull(), F.lit("links")).otherwise(F.lit("default")).alias("link_source"),
    )


# -- departures -------------------------------------------------------------
def expand_departures(predictions: DataFrame) -> DataFrame:
    """One row per bus leaving the first stop, evenly spaced within the hour."""
    buses = explode_range(hourly_departures(predictions), F.lit(0), F.col("buses"), "k")
    return buses.select(
        *ROUTE_DAY,
        bus_id("date", "hour", F.col("k") + 1).alias("bus_id"),
        F.col("hour").alias("departure_hour"),
        _headway().alias("headway_min"),
        _departure().alias("departure_us"),
    )


def hourly_departures(predictions: DataFrame) -> DataFrame:
    """Buses leaving the first stop per hour, rounded half to even."""
    return (
        predictions.where(F.col("stop_seq") == 1)
        .groupBy(*ROUTE_DAY, "hour")
        .agg(F.bround(F.sum("pass_buses"), 0).cast("bigint").alias("buses"))
        .where(F.col("buses") > 0)
    )


def _headway() -> Column:
    return F.lit(60.0) / F.col("buses")


def _departure() -> Column:
    spaced = F.bround(_headway() * F.col("k") * 60e6, 0).cast("bigint")
    return F.col("hour").cast("bigint") * S.US_PER_HOUR + spaced


def bus_id(date: str, hour: str, number: Column) -> Column:
    """'YYYYMMDD-HH-KK'; unique within a route."""
    return F.concat_ws("-", C.compact_date(date), C.two_digits(hour), C.two_digits(number))


# -- arrivals ---------------------------------------------------------------
def day_stops(profile: DataFrame) -> DataFrame:
    """One row per route and date with its stops in order.

    Both possible driving times of a link are worked out here, once per day.
    """

    def drive(kmh: int) -> Column:
        metres_per_minute = F.lit(kmh * 1000.0 / 60.0)
        return F.bround(F.col("link_distance_m") * 60e6 / metres_per_minute, 0).cast("bigint")

    stop = F.struct(
        "stop_seq",
        "stop_id",
        "stop_name",
        drive(S.PEAK_KMH).alias("peak_us"),
        drive(S.OFF_PEAK_KMH).alias("off_peak_us"),
    )
    return profile.groupBy(*ROUTE_DAY).agg(F.sort_array(F.collect_list(stop)).alias("stops"))


def trips_with_arrivals(departures: DataFrame, days: DataFrame) -> DataFrame:
    """One row per trip with the columns of its route's day and the arrival `times`.

    `departures` has a row per bus. There is one join; the left join makes the days,
    never the trips, the side that may be broadcast.
    """
    return _timed(departures.join(days, ROUTE_DAY, "left"), days.columns)


def trips_of_hours(hourly: DataFrame, days: DataFrame) -> DataFrame:
    """The same from the buses per hour: rows are joined while an hour is a few short
    chunks, dealt out, and only then become buses, so no shuffle carries single buses."""
    chunks = range_chunks(hourly, F.lit(0), F.col("buses")).join(days, ROUTE_DAY, "left")
    buses = explode_chunks(chunks.repartition(*ROUTE_DAY, "hour", "_from"), "k")
    named = buses.withColumns(
        {"bus_id": bus_id("date", "hour", F.col("k") + 1), "departure_us": _departure()}
    )
    return _timed(named, days.columns)


def _timed(trips: DataFrame, columns: list[str]) -> DataFrame:
    """Arrival times along the stops. Each link is driven at the speed of the hour in
    which the previous stop was reached, so the step depends on the time computed so
    far: a fold over the trip's ordered stops."""

    def arrive(done: Column, stop: Column) -> Column:
        before = F.coalesce(F.try_element_at(done, F.lit(-1)), F.col("departure_us"))
        link = F.when(C.in_peak(before), stop["peak_us"]).otherwise(stop["off_peak_us"])
        here = F.when(stop["stop_seq"] == 1, F.col("departure_us")).otherwise(before + link)
        return F.array_append(done, here)

    times = F.aggregate("stops", F.array().cast("array<bigint>"), arrive)
    return trips.select(*columns, "bus_id", times.alias("times"))


def _hour_bucket(us: Column) -> Column:
    """Hours since the midnight of the service day; 24 and more on the next day."""
    return F.call_function("div", us, F.lit(S.US_PER_HOUR))


def explode_trips(trips: DataFrame) -> DataFrame:
    """One row per trip and stop."""
    rows = trips.select(*ROUTE_DAY, "bus_id", F.inline(F.arrays_zip("stops", "times")))
    return rows.select(
        *ROUTE_DAY,
        "bus_id",
        "stops.stop_seq",
        "stops.stop_id",
        "stops.stop_name",
        F.col("times").alias("arrival_us"),
    )


def propagate_arrivals(departures: DataFrame, profile: DataFrame) -> DataFrame:
    """Arrival of every trip at every stop of its route and date."""
    return explode_trips(trips_with_arrivals(departures, day_stops(profile)))


def schedule(predictions: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Timetable: arrival of every bus at every stop, with stop id and name."""
    days = day_stops(stop_profile(predictions, links))
    rows = explode_trips(trips_of_hours(hourly_departures(predictions), days))
    hour = _hour_bucket(F.col("arrival_us")) % 24
    return rows.withColumn("arrival_hour", hour.cast("int"))


def schedule_table(timetable: DataFrame) -> DataFrame:
    """The stored form of the timetable, with a timestamp."""
    return timetable.withColumn("arrival_ts", C.moment("date", "arrival_us")).select(
        *S.FINAL_SCHEDULE.fieldNames()
    )


# -- demand and allocation --------------------------------------------------
def _first_present(df: DataFrame, names: list[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def demand_totals(
    rows: DataFrame,
    board_totals: list[str] = S.BOARD_TOTAL_CANDIDATES,
    alight_totals: list[str] = S.ALIGHT_TOTAL_CANDIDATES,
    board_per_bus: list[str] = S.BOARD_PER_BUS_CANDIDATES,
    alight_per_bus: list[str] = S.ALIGHT_PER_BUS_CANDIDATES,
) -> DataFrame:
    """Add board_total and alight_total: a total column if the input has one, else
    a per-bus column times the buses, else 0; never negative."""

    def resolve(totals: list[str], per_bus: list[str]) -> Column:
        if name := _first_present(rows, totals):
            value = C.number_or_zero(name)
        elif name := _first_present(rows, per_bus):
            value = C.number_or_zero(name) * C.number_or_zero("pass_buses")
        else:
            value = F.lit(0.0)
        return C.clip_zero(value)

    return rows.withColumns(
        {
            "board_total": resolve(board_totals, board_per_bus),
            "alight_total": resolve(alight_totals, alight_per_bus),
        }
    )


def onboard_by_bus(rows: DataFrame) -> DataFrame:
    """Passengers on board before and after each stop of a trip.

    The running balance is clipped where it is shown, not where it is carried: a
    dip below zero is remembered. One window group is one trip.
    """
    along = Window.partitionBy(*TRIP).orderBy("stop_seq").rowsBetween(Window.unboundedPreceding, 0)
    delta = F.col("board_per_bus") - F.col("alight_per_bus")
    return rows.withColumn(
        "onboard_after", C.clip_zero(F.sum(delta).over(along))
    ).withColumn("onboard_before", C.clip_zero(F.col("onboard_after") - delta))


def bucket_shares(timetable: DataFrame, demand: DataFrame) -> DataFrame:
    """Demand per bus for every (route, date, sequence, hour) that has buses.

    Counting before joining keeps an hour that holds most of the buses from being
    gathered anywhere. Hours from 24 on belong to the next day and match no demand.
    """
    buses = (
        timetable.withColumn("hour_bucket", _hour_bucket(F.col("arrival_us")))
        .groupBy(*BUCKET)
        .agg(F.count("*").alias("buses_in_hour"))
    )
    totals = demand.groupBy(
        *ROUTE_DAY, "stop_seq", F.col("hour").cast("bigint").alias("hour_bucket")
    ).agg(F.sum("board_total").alias("board_total"), F.sum("alight_total").alias("alight_total"))
    shares = buses.join(totals, BUCKET, "left")
    return shares.withColumns(
        {
            "board_per_bus": C.clip_zero(C.ratio_or_zero("board_total", "buses_in_hour")),
            "alight_per_bus": C.clip_zero(C.ratio_or_zero("alight_total", "buses_in_hour")),
        }
    )


SHARE = ["buses_in_hour", "board_total", "alight_total", "board_per_bus", "alight_per_bus"]


def share_tables(shares: DataFrame) -> DataFrame:
    """One row per route and date: per stop, in order, the shares by hour."""
    by_hour = F.map_from_entries(F.collect_list(F.struct(F.col("hour_bucket"), F.struct(*SHARE))))
    stops = shares.groupBy(*ROUTE_DAY, "stop_seq").agg(by_hour.alias("m"))
    dense = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.array_max(F.map_keys("m"))),
        lambda h: F.try_element_at("m", h),
    )
    in_order = F.array_sort(
        F.collect_list(F.struct(F.col("stop_seq"), dense.alias("by_hour"))),
        lambda a, b: a["stop_seq"] - b["stop_seq"],
    )
    return stops.groupBy(*ROUTE_DAY).agg(in_order.alias("shares"))


def allocation(
    predictions: DataFrame, demand: DataFrame, links: DataFrame | None = None
) -> DataFrame:
    """Demand shared among the buses of each hour, load on board and crowding.

    Trips are made once, into the shared folder. The buses per hour are counted from
    there; then every trip looks its shares up in its route's table of the day and folds
    its own load, so the long rows of trip and stop are never shuffled.
    """
    days = day_stops(stop_profile(predictions, links))
    named = F.transform("stops", lambda s: F.struct(s["stop_seq"], s["stop_id"], s["stop_name"]))
    made = trips_of_hours(hourly_departures(predictions), days).withColumn("stops", named)
    trips = stored(made, "trips")
    trips = trips.join(share_tables(bucket_shares(explode_trips(trips), demand)), ROUTE_DAY, "left")

    def share(time: Column, i: Column) -> Column:
        return F.get(F.get(F.col("shares"), i)["by_hour"], _hour_bucket(time).cast("int"))

    def load(done: Column, x: Column) -> Column:
        before = F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0.0))
        return F.array_append(done, before + (x["board_per_bus"] - x["alight_per_bus"]))

    shared = trips.withColumn("shares", F.transform("times", share))
    loads = F.aggregate("shares", F.array().cast("array<double>"), load)
    rows = shared.withColumn("loads", loads).select(
        *ROUTE_DAY, "bus_id", F.inline(F.arrays_zip("stops", "times", "shares", "loads"))
    )
    rows = rows.select(
        *ROUTE_DAY,
        "bus_id",
        "stops.stop_seq",
        "stops.stop_id",
        "stops.stop_name",
        F.col("times").alias("arrival_us"),
        (_hour_bucket(F.col("times")) % 24).cast("int").alias("arrival_hour"),
        "shares.*",
        C.clip_zero("loads").alias("onboard_after"),
    )
    delta = F.col("board_per_bus") - F.col("alight_per_bus")
    return rows.withColumn("onboard_before", C.clip_zero(F.col("onboard_after") - delta)).withColumn(
        "crowding", C.crowding("onboard_after")
    )


def allocation_report(rows: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """An allocation with its report columns: the approximate demand, which is the
    boardings, and where the route's link distances are from."""
    report = rows.withColumns({"approx_demand": F.col("board_total"), "arrival_ts": C.moment("date", "arrival_us")})
    default = F.lit(S.DEFAULT_LINK_SOURCE)
    if links is None:
        return report.withColumn("link_source", default)
    known = links.select("route_no").distinct().withColumn("_known", F.lit(S.LINK_SOURCE))
    return report.join(known, "route_no", "left").withColumn("link_source", F.coalesce("_known", default)).drop("_known")


def allocation_table(rows: DataFrame) -> DataFrame:
    return rows.withColumn("arrival_ts", C.moment("date", "arrival_us")).select(
        *S.FINAL_ALLOCATION.fieldNames()
    )


# -- prediction post-processing ---------------------------------------------
def onboard_by_hour(rows: DataFrame) -> DataFrame:
    """Running load along the stops within one route, date and hour, clipped."""
    along = (
        Window.partitionBy(*ROUTE_DAY, "hour")
        .orderBy(F.asc_nulls_last("stop_seq"), "stop_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    delta = F.col("board_per_bus") - F.col("alight_per_bus")
    return rows.withColumn("onboard_per_bus", C.clip_zero(F.sum(delta).over(along)))


def predictions_with_meta(scores: DataFrame, fact: DataFrame) -> DataFrame:
    """Predicted totals joined with sequence, name and buses of the same stop hour."""
    keys = ["route_no", "stop_id", "date", "hour"]
    meta = fact.groupBy(*keys).agg(
        F.max("stop_seq").alias("stop_seq"),
        F.max("stop_name").alias("stop_name"),
        F.max(F.coalesce(F.col("ops"), F.lit(0)).cast("double")).alias("pass_buses"),
    )
    return scores.join(meta, keys, "left")


def predictions_output(scores: DataFrame, fact: DataFrame) -> DataFrame:
    """Model scores (yhat_board, yhat_alight) in the shape of the predictions table."""
    rows = predictions_with_meta(scores, fact).withColumns(
        {"pred_board": C.clip_zero("yhat_board"), "pred_alight": C.clip_zero("yhat_alight")}
    )
    rows = rows.withColumns(
        {
            "board_per_bus": C.ratio_or_zero("pred_board", "pass_buses"),
            "alight_per_bus": C.ratio_or_zero("pred_alight", "pass_buses"),
        }
    )
    return onboard_by_hour(rows).select(*S.PREDICTIONS.fieldNames())
