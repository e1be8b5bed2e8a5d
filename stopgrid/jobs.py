"""The batch jobs of the daily cycle: files and tables in, tables out.

Every job works on all routes and dates of its input at once; the optional
arguments narrow it to a month, a route or some dates.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators import demand, features, merge, moves, reshape, serving, trips
from stopgrid.session import releasing, remove_path, stored
from stopgrid.sources import files, xml

# One folder per date and, in the fact table, run; within it files are sorted by route, so
# that a route is found by the files' statistics instead of a folder of a few kilobytes.
FACT_PARTITIONS = ["date", "run_id"]
DATE_PARTITIONS = ["date"]
FACT_ORDER = ["route_no", "hour", "stop_seq", "stop_id"]
TRIP_ORDER = ["route_no", "bus_id", "stop_seq"]


# -- operations: CSV to bronze, silver and gold -----------------------------
def bronze(
    spark: SparkSession, csv: str, out: str, use_ym: str | None = None, route_no: str | None = None
) -> None:
    """Wide operations CSV to Parquet by month and date."""
    rows = files.bronze(files.read_csv_strings(spark, csv), use_ym, route_no)
    merge.write_partitions(rows, out, ["use_ym", "date"])


def silver(
    spark: SparkSession, source: str, out: str, use_ym: str | None = None, route_no: str | None = None
) -> None:
    """Wide bronze rows to one row per hour, by month, route and date."""
    rows = files.read_ops(spark, source, S.BRONZE, use_ym, route_no)
    hours = reshape.hour_columns(rows, S.HOUR_TAG_PREFIX, S.HOUR_TAG_SUFFIX)
    ids = ["route_key", "stop_id", "stop_seq", "route_no", "use_ym", "date"]
    merge.write_partitions(
        reshape.unpivot_hours_zero(rows, hours, ids), out, ["use_ym", "route_no", "date"]
    )


def gold(
    spark: SparkSession, source: str, use_ym: str | None = None, route_no: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Departures per hour and per stop of the silver table."""
    return serving.gold(files.read_ops(spark, source, S.SILVER, use_ym, route_no))


def publish(tables: dict[str, DataFrame], url: str, **properties: str) -> None:
    """Append tables to a database."""
    for name, rows in tables.items():
        files.write_jdbc(rows, url, name, **properties)


# -- raw dimensions and demand ----------------------------------------------
def load_dimensions(spark: SparkSession, route_map_csv: str, link_csv: str, route_map_out: str, link_out: str) -> None:
    """Route map and link files upserted into their tables."""
    route_map = files.load_route_map(merge.with_origin(files.read_csv_strings(spark, route_map_csv)))
    links = files.load_link_distance(merge.with_origin(files.read_csv_strings(spark, link_csv)))
    merge.upsert_table(spark, route_map_out, route_map, S.KEYS["dim_route_map"], [], [merge.ORIGIN])
    merge.upsert_table(spark, link_out, links, S.KEYS["dim_stop_link"], [], [merge.ORIGIN])


def load_master_links(
    spark: SparkSession, master_csv: str, link_out: str, route_key: str | None = None,
    date: str | None = None, rte_id: str | None = None, route_no: str | None = None,
) -> None:
    """Link distances of a stop master upserted into the link table.

    Rows of a file without route keys get `route_key`. Of several rows of a stop the one
    read last counts; rows without a route, stop or sequence are left out.
    """
    raw = merge.with_origin(files.read_csv_strings(spark, master_csv))
    rows = files.load_stop_master(raw, date, rte_id, route_no)
    links = rows.withColumn("route_key", F.coalesce("route_key", F.lit(route_key).cast("string"))).where(F.col("route_key").isNotNull())
    names = [*S.DIM_STOP_LINK.fieldNames(), merge.ORIGIN]
    merge.upsert_table(spark, link_out, links.select(*names), S.KEYS["dim_stop_link"], [], [merge.ORIGIN])


def load_demand(spark: SparkSession, daily_pages: str, monthly_pages: str, daily_out: str, monthly_out: str) -> None:
    """Landed demand pages upserted into the daily and the monthly table.

    Of several rows with the same key the one registered last counts, then that of
    the later file and row.
    """
    daily = xml.daily_rows(xml.read_pages(spark, daily_pages, S.DAILY_SERVICE), origin=True)
    monthly = xml.monthly_rows(xml.read_pages(spark, monthly_pages, S.MONTHLY_SERVICE), origin=True)
    order = ["reg_ymd", merge.ORIGIN]
    merge.upsert_table(
        spark, daily_out, daily.select(*S.DEMAND_DAILY_STOP.fieldNames(), merge.ORIGIN),
        S.KEYS["demand_daily_stop"], ["date"], order,
    )
    merge.upsert_table(
        spark, monthly_out, monthly.select(*S.DEMAND_MONTHLY_HOURLY.fieldNames(), merge.ORIGIN),
        S.KEYS["demand_monthly_hourly"], ["use_ym"], order,
    )


# -- the stop-hour fact table -----------------------------------------------
def csv_stop_days(
    spark: SparkSession, csv: str, route_map: DataFrame | None = None, dates: Iterable[dt.date] | None = None
) -> DataFrame:
    """Stop days of a wide operations CSV, its routes resolved through the map.

    Without a map the route key is the route id itself. `dates` restricts the rows
    before they are ranked.
    """
    rows = files.bronze(files.read_csv_strings(spark, csv))
    if route_map is None:
        rows = rows.withColumn("rte_id", F.col("route_key"))
    else:
        rows = files.filter_route_via_map(rows, route_map)
    hours = reshape.hour_columns(rows, S.HOUR_TAG_PREFIX, S.HOUR_TAG_SUFFIX)
    dated = _on_dates(rows.withColumn("date", C.parse_date("date")), dates)
    return demand.stop_days_from_wide(dated, hours)


# -- the operations cache ---------------------------------------------------
FILE_LEDGER = T.StructType([T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType())])


def refresh_ops_cache(
    spark: SparkSession, pages: str, cache: str, seen: str, route_map: DataFrame | None = None
) -> int:
    """Take pages not seen before into the hourly operations table; how many files they were.

    The ledger `seen` has the path and time of every file taken in, so a file is parsed
    once, and again if it was replaced. Rows are upserted by date, route, stop and hour, the
    later page winning, and the ledger is written last: a run that failed is repeated
    and upserts the same rows. Failed pages give no rows and are not tried again until
    they are replaced.
    """
    with releasing(spark):
        ledger = None
        if merge.path_exists(spark, seen):
            spark.catalog.refreshByPath(seen)
            ledger = spark.read.schema(FILE_LEDGER).parquet(seen)
        fresh = stored(files.unseen_files(spark, pages, "*.xml", ledger), "unseen-files")
        paths = [row["path"] for row in fresh.select("path").collect()]
        if not paths:
            return 0
        wide = xml.ops_rows(xml.read_pages(spark, paths, S.OPS_SERVICE), origin=True)
        if route_map is None:
            named = wide.withColumn("route_no", F.col("rte_id"))
        else:
            named = wide.join(route_map.groupBy("rte_id").agg(F.min("route_no").alias("route_no")), "rte_id")
        # parsed once, before they become 24 rows each and are filtered
        dated = stored(named.withColumn("date", C.parse_date("date")), "new-pages").where(F.col("date").isNotNull())
        hours = {h: f"ops_{h:02d}" for h in range(24)}
        rows = reshape.unpivot_hours(
            dated, hours, ["date", "route_no", "rte_id", "stop_id", "stop_seq", merge.ORIGIN], lambda c: c.cast("bigint")
        )
        names = S.OPS_HOURLY.fieldNames()
        merge.upsert_table(spark, cache, rows.select(*names, merge.ORIGIN), S.KEYS["ops_hourly"], ["date"], [merge.ORIGIN])
        fresh.coalesce(1).write.mode("append").parquet(seen)
    return len(paths)


def read_ops_cache(spark: SparkSession, cache: str, requests: DataFrame | None = None) -> DataFrame:
    """Hourly operations rows of the cache, of the requested (route_no, date) if there are some."""
    spark.catalog.refreshByPath(cache)
    rows = files.read_partitioned(spark, cache, S.OPS_HOURLY)
    return rows if requests is None else merge.cached_rows(requests, rows, ["route_no", "date"], ["date"])


def cached_stop_days(spark: SparkSession, cache: str, requests: DataFrame | None = None) -> DataFrame:
    """Stop days of the operations cache, a source for `build_fact`."""
    return demand.stop_days_from_long(read_ops_cache(spark, cache, requests))


def _on_dates(rows: DataFrame, dates: Iterable[dt.date] | None) -> DataFrame:
    return rows if dates is None else rows.where(F.col("date").isin(list(dates)))


def page_stop_days(
    spark: SparkSession, pages: str, route_map: DataFrame | None = None, dates: Iterable[dt.date] | None = None
) -> DataFrame:
    """Stop days of landed operations pages; without a map a route's number is its id."""
    rows = xml.ops_rows(xml.read_pages(spark, pages, S.OPS_SERVICE))
    if route_map is None:
        mapped = rows.withColumn("route_no", F.col("rte_id"))
    else:
        mapped = rows.join(route_map.groupBy("rte_id").agg(F.min("route_no").alias("route_no")), "rte_id")
    dated = _on_dates(mapped.withColumn("date", C.parse_date("date")), dates)
    return demand.stop_days_from_wide(dated, {h: f"ops_{h:02d}" for h in range(24)})


def incomplete_input(pages: DataFrame, date_tag: str, route_tag: str | None = None) -> DataFrame:
    """(date, route_no) of which rows that were announced did not land.

    A null route stands for all routes of the date. A null date is that of a failed page
    that cannot be told; `build_fact` takes no input with such a page.
    """
    state = xml.page_completeness(pages, date_tag, route_tag)
    return state.where("complete = 0").select(C.parse_date("date").alias("date"), "route_no").distinct()


class IncompleteInput(ValueError):
    """Input pages failed and nothing says of which date they were."""


def link_sources(links: Sequence[DataFrame]) -> DataFrame:
    """Link rows in order of preference: a route and date come whole from the first
    source that has them, and so do a route's undated rows, from a file without dates."""
    shaped = [x if "date" in x.columns else x.withColumn("date", F.lit(None).cast("string")) for x in links]
    columns = ["date", "route_key", "stop_id", "stop_seq", "link_distance_m"]
    shaped = [x.select(*columns) for x in shaped]
    dated = merge.prefer([x.where(F.col("date").isNotNull()) for x in shaped], ["route_key", "date"])
    return dated.unionByName(merge.prefer([x.where(F.col("date").isNull()) for x in shaped], ["route_key"]))


def build_fact(
    spark: SparkSession,
    out: str,
    ledger: str,
    days: Sequence[DataFrame],
    daily: DataFrame,
    monthly: DataFrame | None,
    links: Sequence[DataFrame],
    dates: Iterable[dt.date] | None = None,
    incomplete: DataFrame | None = None,
    quarantine: str | None = None,
) -> str:
    """Build the fact table for the dates not built yet and note each in the ledger.

    `days` and `links` list sources in order of preference: a date and route, or a
    route's links, come whole from the first source that has them. `incomplete` has
    the (date, route_no) that must not be built, as their input is; they keep the rows
    they had. A date is noted as OK with the rows written by this run, NO_DATA, ERROR
    where a route was refused, or SKIPPED_SAME_DATE if it was asked for and is done.

    Rows go into folders of this run, whose id is returned. They count only once the
    ledger names the run, so `read_fact` never sees half a run, nor the rows of one that
    failed before it was noted. Rows whose key is null or repeated go to the table
    `quarantine`, if one is given, with the reason; else they fail the job.
    """
    run = uuid.uuid4().hex
    with releasing(spark):
        ops = merge.prefer(list(days), ["date", "route_no"])
        asked = (
            spark.createDataFrame([(d,) for d in dates], "target_date date")
            if dates is not None
            else ops.select(F.col("date").alias("target_date")).where("target_date is not null").distinct()
        ).withColumn("job_name", F.lit(S.FACT_JOB))
        asked = stored(asked, "fact-asked")
        wanted = asked
        if merge.path_exists(spark, ledger):
            wanted = merge.ledger_pending_dates(asked, read_ledger(spark, ledger))
        wanted = stored(wanted, "fact-dates")
        refused = _refused(spark, wanted, incomplete)
        ops = ops.join(wanted.select(F.col("target_date").alias("date")), "date", "left_semi")
        ops = _without_routes(ops, refused)
        good, bad = merge.split_by_key(ops, demand.DAY_KEYS, demand.hours_clash())
        if quarantine is not None:
            bad.withColumn("run_id", F.lit(run)).write.mode("append").parquet(quarantine)
        elif (first := bad.select(*demand.DAY_KEYS, "reason").first()) is not None:
            raise ValueError(f"rows with a null or repeated key, such as {tuple(first)}")
        rows = spark.createDataFrame([], "target_date date, rows bigint")
        if not good.isEmpty():
            fact = demand.daily_stop_hour(good, daily, monthly, link_sources(links))
            if merge.path_exists(spark, out) and merge.path_exists(spark, ledger):
                # a refused route keeps its rows where other routes of its date are built
                before = read_fact(spark, out, ledger).join(good.select("date").distinct(), "date", "left_semi")
                fact = fact.unionByName(_only_routes(before, refused).select(*fact.columns))
            rows = _written(fact, out, run, [row[0] for row in wanted.select("target_date").collect()])
        tried = wanted.join(rows, "target_date", "left").join(_said(refused), "target_date", "left")
        built_some = F.col("rows") > 0
        told = F.concat(F.lit("rows="), F.coalesce(F.col("rows"), F.lit(0)).cast("string"))
        results = tried.select(
            "job_name",
            "target_date",
            F.when(F.col("refused").isNotNull(), F.lit("ERROR"))
            .when(built_some, F.lit("OK"))
            .otherwise(F.lit("NO_DATA"))
            .alias("status"),
            F.when(F.col("refused").isNotNull(), F.concat(F.lit("input is incomplete: "), "refused", F.lit("; "), told))
            .otherwise(told)
            .alias("message"),
            F.when(built_some, F.lit(run)).alias("run_id"),
        )
        if dates is not None:
            done = asked.join(wanted, ["job_name", "target_date"], "left_anti")
            results = results.unionByName(
                done.select(
                    "job_name", "target_date", F.lit("SKIPPED_SAME_DATE").alias("status"), F.lit("already built").alias("message"),
                    F.lit(None).cast("string").alias("run_id"),
                )
            )
        merge.append_ledger(merge.ledger_entries(results), ledger)
    return run


def _written(fact: DataFrame, out: str, run: str, dates: list[dt.date]) -> DataFrame:
    """Write the rows of a run; (target_date, rows) as counted on their way to the files."""
    seen = Observation(f"fact {run}")
    counts = [F.count_if(F.col("date") == F.lit(d)).alias(str(d)) for d in dates]
    counted = fact.observe(seen, *counts)
    merge.append_partitions(counted.withColumn("run_id", F.lit(run)), out, FACT_PARTITIONS, FACT_ORDER)
    return fact.sparkSession.createDataFrame([(d, seen.get[str(d)]) for d in dates], "target_date date, rows bigint")


def _refused(spark: SparkSession, wanted: DataFrame, incomplete: DataFrame | None) -> DataFrame:
    """The incomplete (date, route_no) among the wanted dates."""
    if incomplete is None:
        return spark.createDataFrame([], "date date, route_no string")
    whole = incomplete if "route_no" in incomplete.columns else incomplete.withColumn("route_no", F.lit(None).cast("string"))
    known = stored(whole.select("date", "route_no").distinct(), "fact-incomplete")
    if not known.where("date is null").isEmpty():
        raise IncompleteInput("a page failed and neither its rows nor its name tell its date")
    return known.join(wanted.select(F.col("target_date").alias("date")), "date", "left_semi")


def _route_among(rows: DataFrame, routes: DataFrame, how: str) -> DataFrame:
    """Rows joined on their date and route; a null route among `routes` stands for all."""
    here, there = rows.alias("here"), routes.alias("there")
    same = (F.col("here.date") == F.col("there.date")) & (
        F.col("there.route_no").isNull() | (F.col("here.route_no") == F.col("there.route_no"))
    )
    return here.join(there, same, how)


def _without_routes(rows: DataFrame, routes: DataFrame) -> DataFrame:
    return _route_among(rows, routes, "left_anti")


def _only_routes(rows: DataFrame, routes: DataFrame) -> DataFrame:
    return _route_among(rows, routes, "left_semi")


def _said(refused: DataFrame) -> DataFrame:
    """Per date the refused routes as a text."""
    route = F.coalesce("route_no", F.lit("all routes"))
    return refused.groupBy(F.col("date").alias("target_date")).agg(
        F.array_join(F.sort_array(F.collect_set(route)), ", ").alias("refused")
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.RUN_LEDGER).parquet(path)


def read_fact(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The fact table as the ledger closed it: of each date the rows of the last run noted for it.

    Dates and runs are partitions, so folders of other runs are not read.
    """
    stored_runs = T.StructType([*S.DAILY_STOP_HOUR.fields, T.StructField("run_id", T.StringType())])
    current = merge.ledger_runs(read_ledger(spark, ledger), S.FACT_JOB)
    rows = files.read_partitioned(spark, path, stored_runs)
    return rows.join(current, ["date", "run_id"], "left_semi").select(*S.DAILY_STOP_HOUR.fieldNames())


def vacuum_fact(spark: SparkSession, path: str, ledger: str) -> int:
    """Remove the folders of runs that were replaced or never noted; how many went.

    Not while another run is being written, and not under a reader of an older state.
    """
    current = {(r["date"], r["run_id"]) for r in merge.ledger_runs(read_ledger(spark, ledger), S.FACT_JOB).collect()}
    listed = spark.read.schema("date date, run_id string").parquet(path).select("date", "run_id").distinct().collect()
    stale = [r for r in listed if (r["date"], r["run_id"]) not in current]
    for r in stale:
        remove_path(spark, f"{path.rstrip('/')}/date={r['date']}/run_id={r['run_id']}")
    return len(stale)


# -- weekday averages kept up to date ---------------------------------------
WEEKDAY_STATES = S.struct(
    "route_no string, hour int, sum_board double, count_board bigint, sum_ops bigint, count_ops bigint, "
    "sum_per_bus double, count_per_bus bigint, dow int"
)


def refresh_weekdays(changed: DataFrame, dates: Iterable[dt.date], states: str, totals: str) -> None:
    """Take the new rows of some dates into the weekday averages.

    `changed` has the fact rows of `dates`, all of them and no others. Their states replace those of the same
    dates; a date left without rows loses its states. The totals of the weekdays concerned
    are then added up from the states of their dates, which hold no stops: neither the
    fact rows of other dates nor the states of other weekdays are read. A repeated run
    changes nothing, and sums do not drift.
    """
    spark, dates = changed.sparkSession, sorted(set(dates))
    weekdays = sorted({d.isoweekday() % 7 + 1 for d in dates})
    with releasing(spark):
        fresh = stored(serving.weekday_states(changed.where(F.col("date").isin(dates))), "weekday-states")
        merge.write_partitions(fresh, states, ["dow", "date"])
        written = {r["date"] for r in fresh.select("date").distinct().collect()}
        for d in dates:
            if d not in written:
                remove_path(spark, f"{states.rstrip('/')}/dow={d.isoweekday() % 7 + 1}/date={d}")
        spark.catalog.refreshByPath(states)
        kept = spark.read.schema(fresh.schema).parquet(states).where(F.col("dow").isin(weekdays))
        merge.write_partitions(serving.merged_states(kept), totals, ["dow"])
        present = {r["dow"] for r in kept.select("dow").distinct().collect()}
        for w in weekdays:
            if w not in present:
                remove_path(spark, f"{totals.rstrip('/')}/dow={w}")
        spark.catalog.refreshByPath(totals)


def read_weekdays(spark: SparkSession, totals: str) -> DataFrame:
    """The weekday averages as the last refresh left them."""
    return serving.averages_of(spark.read.schema(WEEKDAY_STATES).parquet(totals))


def export_fact(fact: DataFrame, path: str) -> None:
    """CSV files under the names of the flat table, by route and date."""
    export_named(fact, S.FACT_NAMES, path)


def export_named(rows: DataFrame, names: dict[str, str], path: str) -> None:
    """CSV files by route and date, the columns under their names in files."""
    named = rows.select(
        F.col("route_no").alias("route"), F.col("date"), *[F.col(n).alias(s) for n, s in names.items()]
    )
    files.write_csv(named, path, ["route", "date"])


def export_predictions(predictions: DataFrame, path: str) -> None:
    export_named(predictions, S.PREDICTION_NAMES, path)


def export_schedule(predictions: DataFrame, links: DataFrame | None, schedule_path: str, allocation_path: str) -> None:
    """The timetable and the allocation report as files."""
    timetable = trips.schedule(predictions, links)
    export_named(timetable.withColumn("arrival_ts", C.moment("date", "arrival_us")), S.SCHEDULE_NAMES, schedule_path)
    demand_rows = trips.demand_totals(predictions, ["pred_board"], ["pred_alight"])
    report = trips.allocation_report(trips.allocation(predictions, demand_rows, links), links)
    export_named(report, S.ALLOCATION_NAMES, allocation_path)


# -- predictions, schedule and reallocation ---------------------------------
def predict(fact: DataFrame, splits: features.Split, output_split: str = "test", loss: str = "absolute") -> DataFrame:
    """Train the demand model and predict the output split in the predictions table's shape.

    Feature rows and windows are written once, as fitting reads them over and over; the
    result reads them too, so they go with the caller's `releasing`.
    """
    rows = stored(features.with_split(features.demand_features(fact), splits), "model-features")
    minmax = features.feature_minmax(rows.where(F.col("split") == "train"))
    windows = features.sequence_windows(features.scale_features(rows, minmax), ["split", *features.SERIES])
    inputs = stored(features.model_input(windows), "model-windows")
    scores = features.demand_scores(inputs, loss=loss).where(F.col("split") == output_split)
    hour = (F.col("hour_index") % 24).cast("int").alias("hour")
    return trips.predictions_output(
        scores.select("route_no", "stop_id", "date", hour, "yhat_board", "yhat_alight"), fact
    )


def build_predictions(fact: DataFrame, splits: features.Split, out: str, output_split: str = "test", loss: str = "absolute") -> None:
    """Predictions of the output split written by date; nothing but them is left."""
    with releasing(fact.sparkSession):
        merge.write_partitions(predict(fact, splits, output_split, loss), out, DATE_PARTITIONS)


def ingest_predictions(spark: SparkSession, paths: Sequence[str], table: str, base: str | None = None) -> None:
    """Prediction files of any accepted spelling upserted into the predictions table."""
    rows = merge.coerce_predictions(files.read_predictions(spark, paths, base))
    merge.upsert_table(spark, table, rows, S.KEYS["predictions"], ["date"], [merge.ORIGIN])


def build_schedule(
    predictions: DataFrame,
    links: DataFrame | None,
    schedule_out: str,
    allocation_out: str,
    first: str | None = None,
    last: str | None = None,
) -> None:
    """Timetable and allocation tables of the dates in the range, by date."""
    if first and last:
        predictions = serving.date_range(predictions, first, last)
    demand_rows = trips.demand_totals(predictions, ["pred_board"], ["pred_alight"])
    timetable = trips.schedule_table(trips.schedule(predictions, links))
    merge.write_partitions(timetable, schedule_out, DATE_PARTITIONS, TRIP_ORDER)
    loads = trips.allocation_table(trips.allocation(predictions, demand_rows, links))
    merge.write_partitions(loads, allocation_out, DATE_PARTITIONS, TRIP_ORDER)


def plan_from_predictions(predictions: DataFrame) -> DataFrame:
    """Departures at the first stop and the highest boarding of any stop, per hour."""
    return (
        predictions.groupBy("route_no", "date", "hour")
        .agg(
            F.bround(
                F.sum(F.when(F.col("stop_seq") == 1, F.col("pass_buses")).otherwise(F.lit(0.0))), 0
            ).cast("bigint").alias("n"),
            F.max("pred_board").alias("l"),
        )
        .where(F.col("n") > 0)
    )


def build_reallocation(predictions: DataFrame, moves_out: str, slots_out: str) -> None:
    """Moves and the even departure slots after them, by date."""
    with releasing(predictions.sparkSession):
        plan = stored(plan_from_predictions(predictions), "plan")
        merge.write_partitions(moves.reallocation_plan(plan), moves_out, ["date"])
        merge.write_partitions(moves.slot_schedule(plan), slots_out, ["date"])
