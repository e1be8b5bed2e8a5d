"""Queries on weights, disaggregation, links and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import jobs
from stopgrid.operators import colocated, demand
from stopgrid.plans.registry import plain, query
from stopgrid.plans.twins import day, r, twin
from stopgrid.sources import tables

WIDE_HOURS = {h: f"ops_{h:02d}" for h in range(24)}

FILLED = f"""coalesce(
    (select avg(l.link_distance_m) from links l where l.route_no = e.route_no and l.stop_id = e.stop_id),
    (select avg(l.link_distance_m) from links l where l.route_no = e.route_no and l.stop_seq = e.stop_seq))"""


@query(
    "hour_weights",
    twin(
        f"select use_ym, route_no, stop_id, hour, {r('w_board')} as w_board, {r('w_alight')} as w_alight from weights",
        "weights",
    ),
)
def hour_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(demand.hour_weights(tables.demand_monthly_hourly(spark, sf_dir)))


@query(
    "uniform_weights",
    twin(
        f"""select route_no, stop_id, hour, {r('cast(1 as double) / 24')} as w_board,
            {r('cast(1 as double) / 24')} as w_alight
        from (select distinct route_no, stop_id from passes) cross join hours""",
        "passes",
        "hours",
    ),
)
def uniform_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(demand.uniform_weights(tables.ops_wide(spark, sf_dir)))


@query(
    "disaggregate_demand",
    twin(
        f"""select {day()} as date, route_no, rte_id, stop_id, stop_seq, hour, ops, stop_name,
            {r('board')} as board, {r('alight')} as alight from estimated""",
        "estimated",
    ),
)
def disaggregate_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        demand.disaggregate_demand(
            tables.ops_hourly(spark, sf_dir),
            tables.demand_daily_stop(spark, sf_dir),
            tables.demand_monthly_hourly(spark, sf_dir),
        )
    )


@query(
    "colocated_demand",
    twin(
        f"""select {day()} as date, route_no, rte_id, stop_id, stop_seq, hour, ops, stop_name,
            {r('board')} as board, {r('alight')} as alight from estimated""",
        "estimated",
    ),
)
def colocated_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables in buckets by route and stop."""
    days = demand.stop_days_from_wide(wide_with_ids(spark, sf_dir), WIDE_HOURS)
    given = [days, tables.demand_daily_stop(spark, sf_dir), tables.demand_monthly_hourly(spark, sf_dir)]
    stop_days, daily, monthly = (colocated.bucketed(df, f"bucketed-{i}") for i, df in enumerate(given))
    return plain(demand.spread_hours(demand.with_demand(stop_days, daily.hint("merge"), monthly.hint("merge"))))


@query(
    "link_distance_fill",
    twin(
        f"""select concat('R-', e.route_no) as route_key, e.stop_id, e.stop_seq, {day('e.date')} as date,
            e.hour, {r(FILLED)} as link_distance_m
        from dsh e""",
        "dsh",
        "links",
    ),
)
def link_distance_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.daily_stop_hour(spark, sf_dir).select(
        tables.route_key("route_no").alias("route_key"), "stop_id", "stop_seq", "date", "hour"
    )
    return plain(demand.fill_links(rows, tables.dim_stop_link(spark, sf_dir)))


LINK_DATES = {"2024-01-05": 1, "2024-01-12": 2, "2024-01-20": 3}
DATED = ", ".join(f"(date '{d}', {n})" for d, n in LINK_DATES.items())
DATED_LINKS = f"""dated as (select l.*, v.since, l.link_distance_m + v.n as m
    from links l, (values {DATED}) v(since, n) where l.stop_seq <> v.n)"""
AS_OF = f"""case when k.since is null then {FILLED} else coalesce(
    (select avg(l.m) from dated l where l.route_no = e.route_no and l.since = k.since and l.stop_id = e.stop_id),
    (select avg(l.m) from dated l where l.route_no = e.route_no and l.since = k.since and l.stop_seq = e.stop_seq)) end"""


@query(
    "link_distance_as_of",
    twin(
        f"""select e.route_no, {day('e.date')} as date, e.stop_id, e.stop_seq, e.hour, {r(AS_OF)} as link_distance_m
        from dsh e left join (
            select d.route_no, d.date, max(l.since) as since from (select distinct route_no, date from dsh) d
            join dated l on l.route_no = d.route_no and l.since <= d.date group by 1, 2
        ) k on k.route_no = e.route_no and k.date = e.date""",
        "dsh",
        "links",
        extra=DATED_LINKS,
    ),
)
def link_distance_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest links that are not younger than the day, before them the undated ones."""
    rows, both = _dated_links(spark, sf_dir)
    filled = demand.fill_links(rows, both, as_of=True)
    return plain(filled.select("route_no", "date", "stop_id", "stop_seq", "hour", "link_distance_m"))


def _dated_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stop hours, and links of three dates, each a little longer and without one stop, beside undated ones."""
    links = tables.dim_stop_link(spark, sf_dir).select("route_key", "stop_id", "stop_seq", "link_distance_m")
    version = F.explode(F.array(*[F.struct(F.lit(d).alias("date"), F.lit(n).alias("n")) for d, n in LINK_DATES.items()]))
    dated = links.withColumn("v", version).where("stop_seq <> v.n").select(
        "route_key", "stop_id", "stop_seq", (F.col("link_distance_m") + F.col("v.n")).alias("link_distance_m"), F.col("v.date").alias("date")
    )
    both = dated.unionByName(links.withColumn("date", F.lit(None).cast("string")))
    rows = tables.daily_stop_hour(spark, sf_dir).withColumn("route_key", tables.route_key("route_no")).drop("link_distance_m")
    return rows, both


MASTER = "(select *, link_distance_m + 9 as m from links where stop_seq <> 3 and route_no <> (select min(route_no) from links))"
PREFERRED = f"""case when e.route_no = (select min(route_no) from links) then {FILLED} else coalesce(
    (select avg(l.m) from {MASTER} l where l.route_no = e.route_no and l.stop_id = e.stop_id),
    (select avg(l.m) from {MASTER} l where l.route_no = e.route_no and l.stop_seq = e.stop_seq)) end"""


@query(
    "link_preference",
    twin(
        f"""select e.route_no, {day('e.date')} as date, e.stop_id, e.stop_seq, e.hour, {r(PREFERRED)} as link_distance_m
        from dsh e""",
        "dsh",
        "links",
    ),
)
def link_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop master lacks the first route and the third stop; a route comes whole from one source."""
    links = tables.dim_stop_link(spark, sf_dir).select("route_key", "stop_id", "stop_seq", "link_distance_m")
    first = links.agg(F.min("route_key")).first()[0]
    master = links.where((F.col("route_key") != first) & (F.col("stop_seq") != 3)).withColumn("link_distance_m", F.col("link_distance_m") + 9)
    rows = tables.daily_stop_hour(spark, sf_dir).withColumn("route_key", tables.route_key("route_no")).drop("link_distance_m")
    filled = demand.fill_links(rows, jobs.link_sources([master, links]))
    return plain(filled.select("route_no", "date", "stop_id", "stop_seq", "hour", "link_distance_m"))


@query(
    "link_distance_by_date",
    twin(
        f"""select e.route_no, {day('e.date')} as date, e.stop_id, e.stop_seq, e.hour, {r(AS_OF)} as link_distance_m
        from dsh e left join (select distinct route_no, since from dated) k on k.route_no = e.route_no and k.since = e.date""",
        "dsh",
        "links",
        extra=DATED_LINKS,
    ),
)
def link_distance_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of a day where it has some, else the undated ones."""
    rows, both = _dated_links(spark, sf_dir)
    return plain(demand.fill_links(rows, both).select("route_no", "date", "stop_id", "stop_seq", "hour", "link_distance_m"))


def wide_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = tables.ops_wide(spark, sf_dir)
    return wide.select(
        F.to_date("date", "yyyyMMdd").alias("date"),
        "route_no",
        F.col("route_key").alias("rte_id"),
        "stop_id",
        F.col("stop_seq").cast("int").alias("stop_seq"),
        *WIDE_HOURS.values(),
    )


@query(
    "daily_stop_hour",
    twin(
        f"""select {day('e.date')} as date, e.rte_id as route_id, e.route_no, e.stop_id, e.hour,
            {r('e.board')} as board, {r('e.alight')} as alight, e.stop_name, e.stop_seq, e.ops,
            {r(FILLED)} as link_distance_m
        from estimated e""",
        "estimated",
        "links",
    ),
)
def daily_stop_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        demand.daily_stop_hour(
            demand.stop_days_from_wide(wide_with_ids(spark, sf_dir), WIDE_HOURS),
            tables.demand_daily_stop(spark, sf_dir),
            tables.demand_monthly_hourly(spark, sf_dir),
            tables.dim_stop_link(spark, sf_dir),
        )
    )
