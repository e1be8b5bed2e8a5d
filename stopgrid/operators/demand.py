"""Hour weights, demand disaggregation and the stop-hour fact table.

All joins run on one row per stop and day, with the 24 hours kept in an array;
the hours are exploded last, so no shuffle carries the 24-fold long rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators.reshape import pack_hours

DAY_KEYS = ["date", "route_no", "stop_id"]
MONTH_KEYS = ["use_ym", "route_no", "stop_id"]


# -- hour weights -----------------------------------------------------------
def _by_hour(value: str) -> Column:
    """Array of 24 sums, null where the hour has no row."""
    return F.array(*[F.sum(F.when(F.col("hour") == h, F.col(value))) for h in range(24)])


def monthly_profiles(monthly: DataFrame) -> DataFrame:
    """One row per (month, route, stop) with two arrays of 24 weights.

    An hour without a monthly row is null, a stop whose month sums to 0 has 1/24.
    """
    sums = monthly.groupBy(*MONTH_KEYS).agg(
        _by_hour("board_total").alias("board"),
        _by_hour("alight_total").alias("alight"),
        F.sum("board_total").alias("board_sum"),
        F.sum("alight_total").alias("alight_sum"),
    )

    def weights(values: str, total: str) -> Column:
        even = F.lit(S.UNIFORM_WEIGHT)
        return F.transform(
            values,
            lambda v: F.when(v.isNotNull(), F.when(F.col(total) > 0, v / F.col(total)).otherwise(even)),
        )

    return sums.select(
        *MONTH_KEYS,
        weights("board", "board_sum").alias("w_board"),
        weights("alight", "alight_sum").alias("w_alight"),
    )


def hour_weights(monthly: DataFrame) -> DataFrame:
    """Share of each hour in the month's total of a stop."""
    return (
        monthly_profiles(monthly)
        .select(
            *MONTH_KEYS,
            F.posexplode(F.arrays_zip(F.col("w_board"), F.col("w_alight"))).alias("hour", "w"),
        )
        .where(F.col("w.w_board").isNotNull() | F.col("w.w_alight").isNotNull())
        .select(*MONTH_KEYS, "hour", "w.w_board", "w.w_alight")
    )


def uniform_weights(ops: DataFrame) -> DataFrame:
    """1/24 for every hour of every stop, used where no monthly table exists."""
    return (
        ops.select("route_no", "stop_id")
        .distinct()
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn("w_board", F.lit(S.UNIFORM_WEIGHT))
        .withColumn("w_alight", F.lit(S.UNIFORM_WEIGHT))
    )


# -- one row per stop and day ----------------------------------------------
def stop_days_from_wide(wide: DataFrame, hours: dict[int, str]) -> DataFrame:
    """Wide rows to one row per (date, route, stop) with an `hours` array.

    `wide` has date, route_no, rte_id, stop_id, stop_seq and the hour columns. A
    stop visited twice on a loop route keeps the visit that sorts last (null last).
    """
    ids = ["date", "route_no", "rte_id", "stop_id", "stop_seq"]
    packed = pack_hours(wide.select(*ids, *[f"`{c}`" for c in hours.values()]), hours, C.whole_or_zero)
    last_visit = Window.partitionBy(*DAY_KEYS).orderBy(F.desc_nulls_first("stop_seq"))
    return packed.withColumn("_n", F.row_number().over(last_visit)).where("_n = 1").drop("_n")


def stop_days_from_long(ops: DataFrame) -> DataFrame:
    """Long hourly counts to the same shape.

    Per hour the last visit wins; a stop whose hours come from several visits
    gives one row per visit. The 24 hours are packed by a partial aggregate before
    the shuffle; what is gathered afterwards are the few visits of a stop on a day.
    """
    count = F.coalesce(F.col("ops"), F.lit(0).cast("bigint"))
    counts = [F.max(F.when(F.col("hour") == h, count)) for h in range(24)]
    visits = ops.groupBy("date", "route_no", "rte_id", "stop_id", "stop_seq").agg(
        F.array(*counts).alias("counts")
    )
    visit = F.struct(F.col("stop_seq").isNull().alias("no_seq"), F.col("stop_seq"), F.col("counts"))
    days = visits.groupBy("date", "route_no", "rte_id", "stop_id").agg(
        F.sort_array(F.collect_list(visit)).alias("visits")
    )

    def taken_later(i: Column, hour: Column) -> Column:
        later = F.slice("visits", i + 2, F.size("visits"))
        return F.exists(later, lambda v: F.get(v["counts"], hour).isNotNull())

    def own_hours(v: Column, i: Column) -> Column:
        entries = F.transform(v["counts"], lambda n, h: F.struct(h.alias("hour"), n.alias("ops")))
        kept = F.filter(entries, lambda x: x["ops"].isNotNull() & ~taken_later(i, x["hour"]))
        return F.struct(v["stop_seq"].alias("stop_seq"), kept.alias("hours"))

    return days.select(
        "date", "route_no", "rte_id", "stop_id", F.inline(F.transform("visits", own_hours))
    )


def hours_clash() -> Column:
    """Whether the rows of a stop and day, as an aggregate, give some hour twice."""
    bits = F.aggregate(
        "hours", F.lit(0), lambda bits, h: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1), h["hour"].cast("int")))
    )
    return F.sum(F.size("hours")) > F.bit_count(F.bit_or(bits))


def with_demand(days: DataFrame, daily: DataFrame, monthly: DataFrame | None) -> DataFrame:
    """Stop days with their daily totals and the 24 weights of their month."""
    totals = daily.groupBy(*DAY_KEYS).agg(
        F.max("stop_name").alias("stop_name"),
        F.max("board_total").alias("board_day"),
        F.max("alight_total").alias("alight_day"),
    )
    joined = days.join(totals, DAY_KEYS, "left")
    if monthly is None:
        none = F.lit(None).cast("array<double>")
        return joined.withColumns({"w_board": none, "w_alight": none})
    profiles = monthly_profiles(monthly)
    return joined.withColumn("use_ym", C.month_of("date")).join(profiles, MONTH_KEYS, "left").drop("use_ym")


def spread_hours(days: DataFrame) -> DataFrame:
    """One row per hour with board = daily total x board weight, alight likewise.

    A stop without totals counts 0, an hour without weight takes 1/24.
    """

    def estimate(total: str, weights: str) -> Column:
        weight = F.coalesce(F.get(F.col(weights), F.col("hour")), F.lit(S.UNIFORM_WEIGHT))
        return F.coalesce(F.col(total), F.lit(0)).cast("double") * weight

    rows = days.select(*[c for c in days.columns if c != "hours"], F.inline("hours"))
    return rows.withColumns(
        {"board": estimate("board_day", "w_board"), "alight": estimate("alight_day", "w_alight")}
    ).drop("board_day", "alight_day", "w_board", "w_alight")


def disaggregate_demand(ops: DataFrame, daily: DataFrame, monthly: DataFrame | None) -> DataFrame:
    """Estimated boardings and alightings per (date, route, stop, hour)."""
    return spread_hours(with_demand(stop_days_from_long(ops), daily, monthly))


# -- link distances ---------------------------------------------------------
def fill_links(rows: DataFrame, links: DataFrame, as_of: bool = False) -> DataFrame:
    """Add link_distance_m: by stop id, else the mean of the same sequence.

    `rows` has route_key, stop_id and stop_seq. Links with a date are those of that
    day and go before the undated ones of the route as a whole; `rows` then has a
    date too. With `as_of` a day takes the route's newest links that are not younger
    than the day. Links become one row per route, or route and date, that holds the
    distances of its stops, so each kind takes one join and never multiplies rows.
    """
    if "date" not in links.columns:
        return _with_links(rows, _link_table(links, ["route_key"]), ["route_key"]).drop("_links")
    day = C.parse_date(F.col("date").cast("string"))
    dated = _link_table(links.where(F.col("date").isNotNull()).withColumn("date", day), ["route_key", "date"])
    always = _link_table(links.where(F.col("date").isNull()), ["route_key"]).withColumnRenamed("_links", "_always")
    if as_of:
        there = dated.withColumnRenamed("date", "_since")
        since = as_of_dates(rows, dated, ["route_key"]).withColumnRenamed("known_date", "_since")
        given = rows.join(since, ["route_key", "date"], "left").join(there, ["route_key", "_since"], "left").drop("_since")
    else:
        given = rows.join(dated, ["route_key", "date"], "left")
    joined = given.join(always, "route_key", "left")
    return _looked_up(joined.withColumn("_links", F.coalesce("_links", "_always"))).drop("_links", "_always")


def as_of_dates(rows: DataFrame, known: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """For each (keys, date) of `rows` the newest date of `known` that is not after it, as `known_date`.

    Dates of both sides are put on one line per key and the last known one is carried
    on, so the rows themselves are not part of it: the line holds a key's distinct dates.
    """
    asked = rows.select(*keys, date).distinct().withColumn("_known", F.lit(None).cast("date"))
    there = known.select(*keys, F.col(date)).distinct().withColumn("_known", F.col(date))
    so_far = Window.partitionBy(*keys).orderBy(date, F.asc_nulls_last("_known")).rowsBetween(Window.unboundedPreceding, 0)
    line = there.unionByName(asked).withColumn("known_date", F.last("_known", ignorenulls=True).over(so_far))
    return line.where(F.col("_known").isNull() & F.col("known_date").isNotNull()).drop("_known")


def _link_table(links: DataFrame, keys: list[str]) -> DataFrame:
    """One row per route (and date) with its stops' mean distances, by id and by sequence.

    The means are taken before anything is gathered, so a row holds one entry per stop.
    """
    name = F.explode(
        F.array(
            F.struct(F.lit("id").alias("by"), F.col("stop_id").cast("string").alias("stop")),
            F.struct(F.lit("seq").alias("by"), F.col("stop_seq").cast("string").alias("stop")),
        )
    )
    each = links.select(*keys, "link_distance_m", name.alias("_n")).where(F.col("_n.stop").isNotNull())
    means = each.groupBy(*keys, "_n.by", "_n.stop").agg(F.avg("link_distance_m").alias("d"))
    entry = F.struct(F.concat_ws(" ", "by", "stop"), "d")
    return means.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_links"))


def _looked_up(rows: DataFrame) -> DataFrame:
    def of(by: str, column: str) -> Column:
        return F.try_element_at("_links", F.concat(F.lit(f"{by} "), F.col(column).cast("string")))

    return rows.withColumn("link_distance_m", F.coalesce(of("id", "stop_id"), of("seq", "stop_seq")))


def _with_links(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    return _looked_up(rows.join(table, keys, "left"))


# -- the fact table ---------------------------------------------------------
def daily_stop_hour(
    days: DataFrame, daily: DataFrame, monthly: DataFrame | None, links: DataFrame
) -> DataFrame:
    """The flat stop-hour fact table from stop days, demand and link distances."""
    rows = with_demand(days, daily, monthly).withColumn("route_key", F.col("rte_id"))
    full = spread_hours(fill_links(rows, links))
    return full.withColumn("route_id", F.col("route_key")).select(*S.DAILY_STOP_HOUR.fieldNames())
