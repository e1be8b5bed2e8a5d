"""Queries on sources, sinks, alignment, merging and the run ledger.

The input files are first written from the given tables into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import jobs
from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators import merge, reshape
from stopgrid.plans import landing
from stopgrid.plans.registry import plain, query
from stopgrid.plans.twins import day, r, twin
from stopgrid.session import shared_path
from stopgrid.sources import files, tables, xml
from stopgrid.streaming import closing
from stopgrid.streaming.incremental import ingest_available

HOURS = {h: f"ops_{h:02d}" for h in range(24)}
FACT_SCHEMA = S.struct(
    "route_no string, date date, stop_seq int, stop_id string, hour int, link_distance_m double, "
    "ops bigint, board double, alight double, stop_name string"
)
FACT_KEYS = ["route_no", "date", "stop_id", "hour"]

PIVOT = ", ".join(
    f"cast(sum(ops) filter (where hour = {h}) as varchar) as ops_{h:02d}" for h in range(24)
)
WIDE = f"""select strftime(date, '%Y%m%d') as date, concat('R-', route_no) as route_key, stop_id,
    cast(stop_seq as varchar) as stop_seq, route_no, cast(sum(ops) as varchar) as ops_day, {PIVOT}
from dsh group by dsh.date, route_no, stop_id, stop_seq"""


def _canonical(raw: DataFrame) -> DataFrame:
    names = {**S.OPS_WIDE_NAMES, **{c: S.hour_tag(h) for h, c in HOURS.items()}}
    return raw.select(*[F.col(f"`{s}`").alias(n) for n, s in names.items()])


# -- CSV --------------------------------------------------------------------
@query("scan_csv_strings", twin(WIDE, "dsh"))
def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(files.read_csv_strings(spark, landing.ops_csv(spark, sf_dir)))


PREDICTION_COLUMNS = f"""select route_no, {day()} as date, hour, stop_id, stop_seq, stop_name,
    {r('pass_buses')} as pass_buses, {r('pred_board')} as pred_board, {r('pred_alight')} as pred_alight,
    {r('board_per_bus')} as board_per_bus, {r('alight_per_bus')} as alight_per_bus,
    cast(0 as double) as onboard_per_bus from preds"""


@query("scan_csv_typed", twin(PREDICTION_COLUMNS, "preds"))
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"route_no": "route_no", "date": "date", **landing.PREDICTION_FILE}
    path = landing.prediction_csv(spark, sf_dir)
    return plain(files.read_csv_typed(spark, path, names, S.PREDICTIONS))


@query("ingest_predictions_by_date", twin(PREDICTION_COLUMNS, "preds"))
def ingest_predictions_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders of all dates; their files' headers are read in one job."""
    base = landing.prediction_csv(spark, sf_dir)
    raw = files.read_predictions(spark, base, base)
    return plain(merge.coerce_predictions(raw).drop(merge.ORIGIN))


@query("load_route_map", twin("select distinct concat('R-', route_no) as route_key, concat('R-', route_no) as rte_id, route_no from passes", "passes"))
def load_route_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load_route_map(files.read_csv_strings(spark, landing.route_map_csv(spark, sf_dir)))


@query("load_link_distance", twin("select route_key, stop_id, stop_seq, link_distance_m from links", "links"))
def load_link_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(files.load_link_distance(files.read_csv_strings(spark, landing.link_csv(spark, sf_dir))))


@query(
    "load_stop_master",
    twin(
        """select distinct strftime(date, '%Y%m%d') as date, concat('R-', route_no) as route_key, stop_id, stop_seq,
            case when stop_seq <> 7 then stop_seq * 100 + cast(0.5 as double) end as link_distance_m
        from passes where stop_seq <> 12""",
        "passes",
    ),
)
def load_stop_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = files.read_csv_strings(spark, landing.stop_master_csv(spark, sf_dir))
    return plain(files.load_stop_master(raw))


# -- bronze and silver ------------------------------------------------------
def _untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows with dashes in the date, blanks around keys and a bad sequence."""
    raw = landing.wide_rows(spark, sf_dir)
    date, seq = S.OPS_WIDE_NAMES["date"], S.OPS_WIDE_NAMES["stop_seq"]
    iso = F.date_format(F.to_date(F.col(date), "yyyyMMdd"), "yyyy-MM-dd")
    padded = [S.OPS_WIDE_NAMES[n] for n in ("route_key", "stop_id", "route_no")]
    return raw.withColumns(
        {
            date: F.concat(F.lit(" "), iso, F.lit(" ")),
            seq: F.when(F.col(seq) == "12", F.lit("last")).otherwise(F.col(seq)),
            **{p: F.concat(F.lit("  "), F.col(p), F.lit(" ")) for p in padded},
        }
    )


def _bronze(spark: SparkSession, sf_dir: str, **filters: str) -> DataFrame:
    rows = files.bronze(_untidy(spark, sf_dir), **filters)
    return rows.withColumnsRenamed(
        {S.OPS_WIDE_NAMES["ops_day"]: "ops_day", **{S.hour_tag(h): c for h, c in HOURS.items()}}
    )


BRONZE = f"""select strftime(date, '%Y%m') as use_ym, strftime(date, '%Y%m%d') as date,
    concat('R-', route_no) as route_key, stop_id, route_no,
    case when stop_seq <> 12 then stop_seq end as stop_seq, cast(sum(ops) as varchar) as ops_day, {PIVOT}
from dsh {{where}} group by dsh.date, route_no, stop_id, stop_seq"""


@query("bronze_normalize", twin(BRONZE.format(where=""), "dsh"))
def bronze_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)


@query(
    "bronze_filter",
    twin(BRONZE.format(where="where strftime(date, '%Y%m') = '202401' and route_no = 'purchase'"), "dsh"),
)
def bronze_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month and route filters of the ingest."""
    return _bronze(spark, sf_dir, use_ym="202401", route_no="purchase")


IDS = ["date", "route_key", "stop_id", "stop_seq", "route_no"]


@query(
    "unpivot_hours",
    twin(
        f"""select strftime(date, '%Y%m%d') as date, concat('R-', route_no) as route_key, stop_id,
            cast(stop_seq as varchar) as stop_seq, route_no, hour, {r('cast(ops as double)')} as ops from grid""",
        "grid",
    ),
)
def unpivot_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = landing.wide_rows(spark, sf_dir).withColumnsRenamed(
        {s: n for n, s in S.OPS_WIDE_NAMES.items()}
    )
    hours = reshape.hour_columns(wide, S.HOUR_TAG_PREFIX, S.HOUR_TAG_SUFFIX)
    return plain(reshape.unpivot_hours(wide, hours, IDS))


@query(
    "unpivot_hours_zero",
    twin(
        """select strftime(date, '%Y%m%d') as date, concat('R-', route_no) as route_key, stop_id,
            cast(stop_seq as varchar) as stop_seq, route_no, hour, coalesce(ops, 0) as ops from grid""",
        "grid",
    ),
)
def unpivot_hours_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = tables.ops_wide(spark, sf_dir)
    return reshape.unpivot_hours_zero(wide, reshape.hour_columns(wide, "ops_"), IDS)


SILVER_SCHEMA = S.struct(
    "route_key string, stop_id string, stop_seq string, hour int, ops bigint, "
    "use_ym string, route_no string, date string"
)


def _silver(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "silver")
    wide = tables.ops_wide(spark, sf_dir)
    rows = reshape.unpivot_hours_zero(wide, reshape.hour_columns(wide, "ops_"), IDS)
    merge.write_partitions(rows.withColumn("use_ym", C.use_ym("date")), path, ["use_ym", "route_no", "date"])
    return path


@query(
    "scan_parquet_pruned",
    twin(
        """select strftime(date, '%Y%m') as use_ym, strftime(date, '%Y%m%d') as date, route_no,
            concat('R-', route_no) as route_key, stop_id, cast(stop_seq as varchar) as stop_seq, hour,
            coalesce(ops, 0) as ops
        from grid where strftime(date, '%Y%m') = '202401' and route_no = 'view'""",
        "grid",
    ),
)
def scan_parquet_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month and route filters on the partition columns of the stored silver table."""
    return files.read_ops(spark, _silver(spark, sf_dir), SILVER_SCHEMA, use_ym="202401", route_no="view")


@query(
    "filter_route_via_map",
    twin(
        """select strftime(date, '%Y%m%d') as date, concat('R-', route_no) as route_key,
            concat('R-', route_no) as rte_id, route_no, stop_id, cast(sum(ops) as varchar) as ops_day
        from dsh where route_no in ('view', 'click') group by dsh.date, route_no, stop_id""",
        "dsh",
    ),
)
def filter_route_via_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the routes, asked for by number and id; the rows of all others drop out."""
    ops = tables.ops_wide(spark, sf_dir).select("date", "route_key", "stop_id", "ops_day")
    route_map = tables.dim_route_map(spark, sf_dir)
    routes = route_map.where(F.col("route_no").isin("view", "click")).select("route_no", "rte_id")
    mapped = files.filter_route_via_map(ops, route_map, routes)
    return mapped.select("date", "route_key", "rte_id", "route_no", "stop_id", "ops_day")


# -- XML --------------------------------------------------------------------
@query(
    "xml_ops_pages",
    twin(
        f"""select {day()} as date, concat('R-', route_no) as rte_id, stop_id, stop_seq, hour,
            coalesce(ops, 0) as ops from grid""",
        "grid",
    ),
)
def xml_ops_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = xml.read_pages(spark, landing.ops_pages(spark, sf_dir), S.OPS_SERVICE)
    rows = xml.ops_rows(pages).withColumn("date", C.parse_date("date"))
    ids = ["date", "rte_id", "stop_id", "stop_seq"]
    return plain(reshape.unpivot_hours_zero(rows, HOURS, ids))


GOOD_DAYS = """(select *, sum(alight_total) over w > sum(board_total) over w as failed,
    count(*) over w as landed from daily window w as (partition by route_no, date))"""


@query(
    "xml_daily_demand",
    twin(
        f"""select {day()} as date, rte_id, route_no, stop_id, stop_name, board_total, alight_total,
            {day('reg_ymd')} as reg_ymd from {GOOD_DAYS} x where not failed""",
        "daily",
    ),
)
def xml_daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = xml.read_pages(spark, landing.daily_pages(spark, sf_dir), S.DAILY_SERVICE)
    return plain(xml.daily_rows(pages))


@query(
    "xml_monthly_hourly",
    twin(
        """select s.use_ym, s.route_no, s.stop_id, s.stop_name, '2024-02-03' as reg_ymd, h.hour,
            coalesce(m.board_total, 0) as board_total, coalesce(m.alight_total, 0) as alight_total
        from (select distinct use_ym, route_no, stop_id, stop_name from monthly) s cross join hours h
        left join monthly m on m.use_ym = s.use_ym and m.route_no = s.route_no and m.stop_id = s.stop_id
            and m.hour = h.hour""",
        "monthly",
        "hours",
    ),
)
def xml_monthly_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = xml.read_pages(spark, landing.monthly_pages(spark, sf_dir), S.MONTHLY_SERVICE)
    return plain(xml.monthly_rows(pages))


@query(
    "xml_page_completeness",
    twin(
        f"""select strftime(date, '%Y%m%d') as date, route_no, total, case when failed then 0 else landed end as landed,
            cast(1 as bigint) as pages, cast(failed as bigint) as errors,
            case when landed >= total and not failed then 1 else 0 end as complete
        from (select distinct date, route_no, landed, failed,
            landed + case when isodow(date) >= 6 then 1 else 0 end as total from {GOOD_DAYS}) x""",
        "daily",
    ),
)
def xml_page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = xml.read_pages(spark, landing.daily_pages(spark, sf_dir), S.DAILY_SERVICE)
    return xml.page_completeness(pages, S.DAILY_TAGS["date"], S.DAILY_TAGS["route_no"])


@query(
    "xml_page_gaps",
    twin(
        """select strftime(date, '%Y%m%d') as date, route_no, case when date_part('day', date) % 4 <> 3 then n end as total,
            case date_part('day', date) % 4 when 1 then 6 when 2 then 11 else n + 1 end as first_missing,
            case date_part('day', date) % 4 when 1 then least(10, n) when 2 then least(15, n) end as last_missing
        from (select date, route_no, count(*) as n from daily group by 1, 2)
        where case date_part('day', date) % 4 when 1 then n > 5 when 2 then n > 10 when 3 then true else false end""",
        "daily",
    ),
)
def xml_page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers that no landed page holds; a page that landed twice does not hide a missing one."""
    pages = xml.read_pages(spark, landing.numbered_pages(spark, sf_dir), S.DAILY_SERVICE)
    return xml.page_gaps(pages, S.DAILY_TAGS["date"], S.DAILY_TAGS["route_no"])


@query(
    "xml_error_pages",
    twin(
        f"""select code, message, cast(count(*) as bigint) as pages, cast(sum(landed) as bigint) as rows from (
            select distinct date, route_no, landed, 'ERROR-500' as code, 'message' as message
            from {GOOD_DAYS} where failed) group by code, message""",
        "daily",
    ),
)
def xml_error_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = xml.read_pages(spark, landing.daily_pages(spark, sf_dir), S.DAILY_SERVICE)
    return xml.error_pages(pages).groupBy("code", "message").agg(
        F.count("*").alias("pages"), F.sum("n_rows").alias("rows")
    )


# -- alignment --------------------------------------------------------------
@query(
    "align_columns",
    twin(
        f"""select {day()} as date, hour, stop_id, stop_seq, stop_name, pass_buses, pred_board, pred_alight,
            cast(0 as double) as board_per_bus, cast(0 as double) as alight_per_bus,
            cast(0 as double) as onboard_per_bus from preds""",
        "preds",
    ),
)
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = tables.predictions(spark, sf_dir).select(
        F.col("date").alias("DATE"),
        F.col("hour").alias("HOUR"),
        F.col("stop_id").alias("정류장ID"),
        F.col("stop_seq").alias("STOP_SEQ"),
        F.col("stop_name").alias("정류장명"),
        F.col("pass_buses").alias("departures"),
        F.col("pred_board").alias("pred_board_total"),
        F.col("pred_alight").alias("예측_하차인원"),
    )
    defaults = {n: 0.0 for n in ("board_per_bus", "alight_per_bus", "onboard_per_bus")}
    return plain(merge.align_columns(other, S.PREDICTION_ALIASES, defaults=defaults))


@query(
    "coerce_predictions",
    twin(
        f"""select route_no, {day()} as date, hour, stop_id,
            case when stop_seq = 12 then 0 else stop_seq end as stop_seq,
            case when stop_seq <> 3 then stop_name end as stop_name, {r('pass_buses')} as pass_buses,
            case when hour < 5 then 0 else {r('pred_board')} end as pred_board, {r('pred_alight')} as pred_alight,
            {r('board_per_bus')} as board_per_bus, {r('alight_per_bus')} as alight_per_bus,
            cast(0 as double) as onboard_per_bus from preds""",
        "preds",
    ),
)
def coerce_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.predictions(spark, sf_dir)
    untyped = rows.select(
        "route_no",
        F.when(F.col("hour") < 12, C.compact_date("date"))
        .otherwise(F.date_format("date", "yyyy-MM-dd"))
        .alias("date"),
        F.concat(F.col("hour").cast("string"), F.lit(".0")).alias("hour"),
        "stop_id",
        F.when(F.col("stop_seq") == 12, F.lit("end")).otherwise(F.col("stop_seq").cast("string")).alias("stop_seq"),
        F.when(F.col("stop_seq") != 3, F.col("stop_name")).alias("stop_name"),
        F.col("pass_buses").cast("string").alias("통과대수"),
        F.when(F.col("hour") < 5, F.lit("n/a")).otherwise(F.col("pred_board").cast("string")).alias("yhat_board_total"),
        F.col("pred_alight").cast("string").alias("yhat_alight_total"),
        F.col("board_per_bus").cast("string").alias("per_bus_board"),
        F.col("alight_per_bus").cast("string").alias("per_bus_alight"),
        F.lit(None).cast("string").alias("per_bus_onboard"),
    )
    return plain(merge.coerce_predictions(untyped))


# -- source preference ------------------------------------------------------
def _stored_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "stored")
    merge.write_partitions(tables.prev_batch(spark, sf_dir), path, ["date"])
    return files.read_partitioned(spark, path, FACT_SCHEMA)


NEW = "(date >= date '2024-01-15')"


@query(
    "source_preference",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour,
            case when dsh.{NEW[1:-1]} then ops + 1 else ops end as ops,
            case when dsh.{NEW[1:-1]} then 'file' else 'stored' end as source from dsh""",
        "dsh",
    ),
)
def source_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of the new file come from it, all others from the stored table."""
    columns = ["route_no", "date", "stop_id", "hour", "ops"]
    new = tables.new_batch(spark, sf_dir).select(*columns, F.lit("file").alias("source"))
    stored = _stored_prev(spark, sf_dir).select(*columns, F.lit("stored").alias("source"))
    return plain(merge.prefer([new, stored], ["date", "route_no"]))


REQUESTED = """(select route_no, date from daily group by 1, 2 having sum(alight_total) < sum(board_total))"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = tables.demand_daily_stop(spark, sf_dir)
    totals = daily.groupBy("route_no", "date").agg(
        F.sum("alight_total").alias("a"), F.sum("board_total").alias("b")
    )
    return totals.where("a < b").select("route_no", "date")


@query(
    "read_ops_cached",
    twin(
        f"""select d.route_no, {day('d.date')} as date, d.stop_id, d.hour, d.ops from dsh d
        join {REQUESTED} q on q.route_no = d.route_no and q.date = d.date where d.date < date '2024-01-16'""",
        "dsh",
        "daily",
    ),
)
def read_ops_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_prev(spark, sf_dir)
    rows = merge.cached_rows(_requests(spark, sf_dir), stored, ["route_no", "date"], partitions=["date"])
    return plain(rows.select("route_no", "date", "stop_id", "hour", "ops"))


@query(
    "ops_cache_state",
    twin(
        f"""select q.route_no, {day('q.date')} as date, count(d.ops) as cached_rows from {REQUESTED} q
        left join dsh d on q.route_no = d.route_no and q.date = d.date and d.date < date '2024-01-16'
        group by q.route_no, q.date""",
        "dsh",
        "daily",
    ),
)
def ops_cache_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        merge.cache_state(_requests(spark, sf_dir), _stored_prev(spark, sf_dir), ["route_no", "date"])
    )


@query(
    "ops_cache_refresh",
    twin(
        f"""select g.route_no, {day('g.date')} as date, g.stop_id, g.stop_seq, g.hour,
            case when g.date >= date '2024-01-15' and g.ops > 0 then g.ops + 1 else coalesce(g.ops, 0) end as ops
        from grid g join {REQUESTED} q on q.route_no = g.route_no and q.date = g.date""",
        "grid",
        "daily",
    ),
)
def ops_cache_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of pages, the second correcting the last date of the first; read through by route and date."""
    pages, cache, seen = (shared_path(spark, n) for n in ("cache-pages", "cache", "cache-files"))
    route_map = tables.dim_route_map(spark, sf_dir)
    for part in ("first", "second"):
        landing.ops_pages_part(spark, sf_dir, f"{pages}/{part}", part)
        jobs.refresh_ops_cache(spark, pages, cache, seen, route_map)
    rows = jobs.read_ops_cache(spark, cache, _requests(spark, sf_dir))
    return plain(rows.select("route_no", "date", "stop_id", "stop_seq", "hour", "ops"))


# -- sinks and upserts ------------------------------------------------------
UPSERTED = f"""select route_no, {day()} as date, stop_id, stop_seq, hour,
    case when dsh.{NEW[1:-1]} then ops + 1 else ops end as ops,
    {r('board')} as board, {r('alight')} as alight from dsh"""


def _shown(df: DataFrame) -> DataFrame:
    return plain(df.select("route_no", "date", "stop_id", "stop_seq", "hour", "ops", "board", "alight"))


@query("sink_parquet_dynamic_overwrite", twin(UPSERTED, "dsh"))
def sink_parquet_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces the dates it holds and leaves the others."""
    path = shared_path(spark, "fact")
    for batch in (tables.prev_batch(spark, sf_dir), tables.new_batch(spark, sf_dir)):
        merge.write_partitions(batch, path, ["date"], ["route_no", "hour", "stop_seq"])
    return _shown(files.read_partitioned(spark, path, FACT_SCHEMA))


@query("sink_csv_partitioned", twin(UPSERTED, "dsh"))
def sink_csv_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "fact-csv")
    for batch in (tables.prev_batch(spark, sf_dir), tables.new_batch(spark, sf_dir)):
        files.write_csv(batch, path, ["route_no", "date"])
    names = {f.name: f.name for f in FACT_SCHEMA}
    return _shown(files.read_csv_typed(spark, path, names, FACT_SCHEMA))


@query("upsert_replace", twin(UPSERTED, "dsh"))
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches upserted into a stored table; the second lands twice, and the later files win."""
    path, land = shared_path(spark, "upserted"), shared_path(spark, "upsert-landing")
    merge.upsert_table(spark, path, tables.prev_batch(spark, sf_dir), FACT_KEYS, ["date"], ["stop_seq"])
    _land_twice(spark, sf_dir, land)
    batch = merge.with_origin(files.read_partitioned(spark, land, FACT_SCHEMA))
    merge.upsert_table(spark, path, batch, FACT_KEYS, ["date"], [merge.ORIGIN])
    return _shown(files.read_partitioned(spark, path, FACT_SCHEMA))


def _land_twice(spark: SparkSession, sf_dir: str, land: str) -> None:
    """The new batch with wrong counts, then, in later files, with the right ones."""
    new = tables.new_batch(spark, sf_dir).select(*FACT_SCHEMA.fieldNames())
    for batch in (new.withColumn("ops", F.col("ops") + 70), new):
        batch.write.mode("append").parquet(land)


@query(
    "upsert_predictions",
    twin(
        f"""select route_no, {day()} as date, hour, stop_id, stop_name,
            {r("pass_buses + case when preds.date >= date '2024-01-15' then 2 else 0 end")} as pass_buses,
            {r('pred_board')} as pred_board from preds""",
        "preds",
    ),
)
def upsert_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corrected batch, in which every key comes twice, merged over the first."""
    rows = tables.predictions(spark, sf_dir)
    late = F.col("date") >= F.lit(tables.NEW_FROM).cast("date")
    first = rows.where(F.col("date") < F.lit(tables.PREV_UNTIL).cast("date"))
    again = rows.where(late).withColumn("_order", F.explode(F.array(F.lit(1), F.lit(2))))
    again = again.withColumn("pass_buses", F.col("pass_buses") + F.col("_order"))
    merged = merge.merge_upsert(first, again, S.KEYS["predictions"], ["_order"])
    return plain(
        merged.select("route_no", "date", "hour", "stop_id", "stop_name", "pass_buses", "pred_board")
    )


@query("incremental_available_now", twin(UPSERTED, "dsh"))
def incremental_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs of the stream over a growing landing folder; in the second each
    key lands twice in one batch."""
    land, table, mark = (shared_path(spark, n) for n in ("landing", "streamed", "stream-mark"))
    tables.prev_batch(spark, sf_dir).select(*FACT_SCHEMA.fieldNames()).write.mode("append").parquet(land)
    ingest_available(spark, land, table, mark, FACT_SCHEMA, FACT_KEYS, ["date"])
    _land_twice(spark, sf_dir, land)
    ingest_available(spark, land, table, mark, FACT_SCHEMA, FACT_KEYS, ["date"])
    return _shown(files.read_partitioned(spark, table, FACT_SCHEMA))


# -- ledger and keys --------------------------------------------------------
LEDGER = f"""(select date_diff('day', date '1970-01-01', date) * 2 + run as id,
    '{S.FACT_JOB}' as job_name, date as target_date,
    case when run = 0 then 'NO_DATA' when day(date) % 4 = 1 then 'OK' when day(date) % 4 = 3
        then 'SKIPPED_SAME_DATE' else 'ERROR' end as status
    from (select distinct date from passes) cross join (select unnest([0, 1]) as run))"""


@query(
    "ledger_latest",
    twin(
        f"""select job_name, id, {day('target_date')} as target_date, status from {LEDGER}
        qualify row_number() over (partition by job_name order by id desc) = 1""",
        "passes",
    ),
)
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(merge.ledger_latest(tables.run_ledger(spark, sf_dir)))


@query(
    "ledger_pending_dates",
    twin(
        f"""select '{S.FACT_JOB}' as job_name, {day()} as target_date from (select distinct date from passes) x
        where day(x.date) % 2 = 0""",
        "passes",
    ),
)
def ledger_pending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = tables.run_ledger(spark, sf_dir)
    return plain(merge.ledger_pending_dates(ledger.select("job_name", "target_date").distinct(), ledger))


@query(
    "key_violations",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour, count(*) as rows, false as has_null from passes
        group by route_no, passes.date, stop_id, hour having count(*) > 1""",
        "passes",
    ),
)
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw passes checked against the key of the fact table."""
    rows = tables.passes(spark, sf_dir).withColumn("stop_id", tables.stop_id())
    return plain(merge.key_violations(rows, FACT_KEYS))


# -- quarantine -------------------------------------------------------------
@query(
    "quarantined_rows",
    twin(
        f"""select route_no, {day()} as date, case when stop_seq <> 7 then stop_id end as stop_id, hour, ops,
            case when stop_seq = 7 then 'null key' else 'repeated key' end as reason
        from dsh, range(case when stop_seq <> 7 and hour = 9 then 2 when stop_seq = 7 then case when hour = 9 then 2 else 1 end else 0 end)""",
        "dsh",
    ),
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the seventh stop have lost its id, and those of nine o'clock come twice."""
    rows = tables.daily_stop_hour(spark, sf_dir).withColumn("stop_id", F.when(F.col("stop_seq") != 7, F.col("stop_id")))
    given = rows.unionByName(rows.where("hour = 9"))
    _, bad = merge.split_by_key(given, S.KEYS["daily_stop_hour"])
    return plain(bad.select("route_no", "date", "stop_id", "hour", "ops", "reason"))


# -- dates that close by themselves -----------------------------------------
@query(
    "closing_dates",
    twin(
        """select strftime(date, '%Y%m%d') as date, route_no, event, n as landed, n as total
        from (select date, route_no, count(*) as n from daily group by 1, 2), (values ('closed', 0), ('late', 1)) v(event, late)
        where late = 0 or date_part('day', date) % 4 = 1""",
        "daily",
    ),
)
def closing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches: the first pages, the other ones, and a page too late on every fourth day."""
    spans = landing.page_spans_in_batches(spark, sf_dir)
    out, checkpoint = shared_path(spark, "closing"), shared_path(spark, "closing-checkpoint")
    stream = spark.readStream.schema(closing.SPANS).option("maxFilesPerTrigger", 1).parquet(spans)
    closing.follow(stream, out, checkpoint)
    return spark.read.schema(closing.EVENTS).parquet(out)
