"""Moving departures from spare to crowded hours, and reports on the moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators.reshape import explode_range
from stopgrid.operators.trips import bus_id

ROUTE_DAY = ["route_no", "date"]


def hour_needs(plan: DataFrame) -> DataFrame:
    """Buses to spare and buses missing per hour of a route and date.

    `plan` has route_no, date, hour, n (departures) and l (highest load). An hour
    needs ceil(l / 49.5) buses, at least one; the first and last three service
    hours are protected.
    """
    day = Window.partitionBy(*ROUTE_DAY)
    need = F.greatest(F.ceil(F.col("l") / S.CROWDED_LOAD), F.lit(1)).cast("bigint")
    open_hour = (F.col("hour") >= F.min("hour").over(day) + S.PROTECTED_HOURS) & (
        F.col("hour") <= F.max("hour").over(day) - S.PROTECTED_HOURS
    )
    rows = plan.where(F.col("n") > 0).withColumn("need", need).withColumn("open", open_hour)
    zero = F.lit(0).cast("bigint")
    return rows.withColumns(
        {
            "spare": F.when(F.col("open"), F.greatest(F.col("n") - F.col("need"), zero)).otherwise(zero),
            "deficit": F.when(F.col("open"), F.greatest(F.col("need") - F.col("n"), zero)).otherwise(zero),
        }
    )


def move_segments(needs: DataFrame) -> DataFrame:
    """Runs of moves with the same donor and receiver hour.

    Spare buses are lined up by (spare desc, hour) and missing buses by (deficit
    desc, hour); the i-th spare bus fills the i-th gap. Instead of ranking single
    buses, the hours' running totals cut the line into at most 47 runs a day, and
    each cut takes the latest donor and receiver that started before it. Windows
    hold the 24 hours of one route and date.
    """

    def line(amount: str) -> Column:
        order = Window.partitionBy(*ROUTE_DAY).orderBy(F.desc(amount), "hour")
        return F.sum(amount).over(order.rowsBetween(Window.unboundedPreceding, 0))

    starts = needs.withColumns(
        {"spare_end": line("spare"), "deficit_end": line("deficit")}
    ).withColumns(
        {
            "spare_start": F.col("spare_end") - F.col("spare"),
            "deficit_start": F.col("deficit_end") - F.col("deficit"),
        }
    )
    none = F.lit(None)
    cuts = starts.select(
        *ROUTE_DAY,
        F.inline(
            F.array(
                F.struct(
                    F.col("spare_start").alias("at"),
                    F.when(
                        F.col("spare") > 0,
                        F.struct("hour", F.col("spare_start").alias("start"), F.col("spare_end").alias("end"), "n"),
                    ).alias("donor"),
                    none.cast("struct<hour:int,start:bigint,end:bigint>").alias("receiver"),
                    (F.col("spare") > 0).alias("used"),
                ),
                F.struct(
                    F.col("deficit_start").alias("at"),
                    none.cast("struct<hour:int,start:bigint,end:bigint,n:bigint>").alias("donor"),
                    F.when(
                        F.col("deficit") > 0,
                        F.struct("hour", F.col("deficit_start").alias("start"), F.col("deficit_end").alias("end")),
                    ).alias("receiver"),
                    (F.col("deficit") > 0).alias("used"),
                ),
            )
        ),
    ).where("used")
    seen = Window.partitionBy(*ROUTE_DAY).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*ROUTE_DAY).orderBy("at")
    runs = cuts.withColumns(
        {
            "donor": F.max(F.struct(F.col("donor.start"), F.col("donor"))).over(seen)["donor"],
            "receiver": F.max(F.struct(F.col("receiver.start"), F.col("receiver"))).over(seen)["receiver"],
            "next_at": F.lead("at").over(after),
        }
    )
    upto = F.least("next_at", "donor.end", "receiver.end")
    both = F.col("donor").isNotNull() & F.col("receiver").isNotNull()
    return runs.where(both & (F.col("at") < upto)).select(
        *ROUTE_DAY,
        F.col("donor.hour").alias("from_hour"),
        F.col("receiver.hour").alias("to_hour"),
        F.col("at").alias("first_move"),
        upto.alias("end_move"),
        (F.col("donor.n") - (F.col("at") - F.col("donor.start"))).alias("first_number"),
    )


def reallocation_plan(plan: DataFrame) -> DataFrame:
    """One row per moved departure; the highest bus of the donor hour goes first."""
    runs = move_segments(hour_needs(plan)).withColumn(
        "count", F.col("end_move") - F.col("first_move")
    )
    moves = explode_range(
        runs.select(*ROUTE_DAY, "from_hour", "to_hour", "first_number", "count"),
        F.lit(0),
        F.col("count"),
        "i",
    )
    return moves.select(
        *ROUTE_DAY,
        bus_id("date", "from_hour", F.col("first_number") - F.col("i")).alias("move_bus_id"),
        "from_hour",
        "to_hour",
    )


def moved_hours(plan: DataFrame) -> DataFrame:
    """Departures per hour before (n) and after (n_new) the moves.

    What an hour gives or takes follows from the running totals alone: the first
    min(total spare, total deficit) units of each line are moved.
    """
    needs = hour_needs(plan)
    day = Window.partitionBy(*ROUTE_DAY)
    moved = F.least(F.sum("spare").over(day), F.sum("deficit").over(day))

    def taken(amount: str) -> Column:
        order = day.orderBy(F.desc(amount), "hour").rowsBetween(Window.unboundedPreceding, 0)
        start = F.sum(amount).over(order) - F.col(amount)
        zero = F.lit(0).cast("bigint")
        return F.greatest(F.least(F.col(amount), F.col("moved") - start), zero)

    rows = needs.withColumn("moved", moved).withColumns(
        {"moved_out": taken("spare"), "moved_in": taken("deficit")}
    )
    return rows.select(
        *ROUTE_DAY,
        "hour",
        "n",
        "moved_out",
        "moved_in",
        (F.col("n") - F.col("moved_out") + F.col("moved_in")).alias("n_new"),
    )


def slot_schedule(plan: DataFrame) -> DataFrame:
    """Evenly spaced departures of every hour after the moves, slots from 1."""
    slots = explode_range(
        moved_hours(plan).select(*ROUTE_DAY, "hour", "n_new"), F.lit(0), F.col("n_new"), "k"
    )
    offset = F.bround(F.lit(60.0) / F.col("n_new") * F.col("k") * 60e6, 0).cast("bigint")
    return slots.select(
        *ROUTE_DAY,
        "hour",
        (F.col("k") + 1).alias("slot_idx"),
        (F.col("hour").cast("bigint") * S.US_PER_HOUR + offset).alias("departure_us"),
    )


def reallocation_compare(plan: DataFrame) -> DataFrame:
    """Current and recommended departures and headway per hour."""
    return moved_hours(plan).select(
        *ROUTE_DAY,
        "hour",
        F.col("n").alias("current_departures"),
        F.col("n_new").alias("recommended_departures"),
        C.minutes_between("n").alias("current_headway_min"),
        C.minutes_between("n_new").alias("recommended_headway_min"),
    )


# -- reports on a move plan -------------------------------------------------
def _in_and_out(moves: DataFrame, keys: list[str]) -> DataFrame:
    """Moves counted at both ends in one pass."""
    ends = F.array(
        F.struct(F.col("from_hour").alias("hour"), F.lit(1).alias("out"), F.lit(0).alias("in")),
        F.struct(F.col("to_hour").alias("hour"), F.lit(0).alias("out"), F.lit(1).alias("in")),
    )
    return (
        moves.select(*keys, F.inline(ends))
        .groupBy(*keys, "hour")
        .agg(F.sum("out").alias("moved_out"), F.sum("in").alias("moved_in"))
        .withColumn("net_change", F.col("moved_in") - F.col("moved_out"))
    )


def net_change_by_day_hour(moves: DataFrame) -> DataFrame:
    """Departures lost, gained and net for the hours that any move touches."""
    return _in_and_out(moves, ROUTE_DAY)


def moves_by_hour(moves: DataFrame) -> DataFrame:
    """The same for all 24 hours of every route and date that has a move."""
    counts = _in_and_out(moves, ROUTE_DAY)
    per_day = counts.groupBy(*ROUTE_DAY).agg(
        F.map_from_entries(F.collect_list(F.struct("hour", F.struct("moved_out", "moved_in")))).alias("m")
    )
    hours = per_day.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    found = F.try_element_at("m", F.col("hour"))
    return hours.select(
        *ROUTE_DAY,
        "hour",
        F.coalesce(found["moved_out"], F.lit(0)).alias("moved_out"),
        F.coalesce(found["moved_in"], F.lit(0)).alias("moved_in"),
    ).withColumn("net_change", F.col("moved_in") - F.col("moved_out"))


def move_matrix(moves: DataFrame) -> DataFrame:
    """Moves from each hour (rows) to each hour (columns to_00 .. to_23) per route and date."""
    return moves.groupBy(*ROUTE_DAY, "from_hour").agg(
        *[F.count(F.when(F.col("to_hour") == h, 1)).alias(f"to_{h:02d}") for h in range(24)]
    )


def moves_per_day(moves: DataFrame) -> DataFrame:
    return moves.groupBy(*ROUTE_DAY).agg(F.count("*").alias("moves"))


def slots_per_hour(slots: DataFrame) -> DataFrame:
    return slots.groupBy(*ROUTE_DAY, "hour").agg(F.countDistinct("slot_idx").alias("slots"))


def available_dates(moves: DataFrame, slots: DataFrame) -> DataFrame:
    """Dates that occur in either table."""
    return moves.select("date").distinct().union(slots.select("date").distinct()).distinct()


def plan_dates(plan: DataFrame) -> DataFrame:
    """Dates that moves or departure slots of a plan can have, without working them out.

    Moves keep the number of departures of a route and date, so a date has slots, and
    may have moves, exactly if some hour of it has departures.
    """
    return plan.where(F.col("n") > 0).select("date").distinct()


def move_sentences(moves: DataFrame, limit: int | None = None) -> DataFrame:
    """One line of text per move; `limit` keeps the first ones by date and bus."""
    text = F.format_string(S.MOVE_SENTENCE, F.col("from_hour"), F.col("to_hour"), F.col("move_bus_id"))
    if limit is not None:
        moves = moves.orderBy("date", "route_no", "move_bus_id").limit(limit)
    return moves.withColumn("sentence", text)


def slot_sentences(slots: DataFrame) -> DataFrame:
    """One line of text per departure slot."""
    text = F.format_string(
        S.SLOT_SENTENCE,
        F.col("hour"),
        F.col("slot_idx"),
        F.date_format(C.moment("date", "departure_us"), "HH:mm:ss"),
    )
    return slots.withColumn("sentence", text)
