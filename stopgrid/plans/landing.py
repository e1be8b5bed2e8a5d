"""Input files written from the given tables, in the formats the sources read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.session import shared_path
from stopgrid.sources import files, tables, xml


def _named(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(s) for n, s in names.items()])


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide operations rows under the file's column names."""
    wide = tables.ops_wide(spark, sf_dir)
    names = {**S.OPS_WIDE_NAMES, **{f"ops_{h:02d}": S.hour_tag(h) for h in range(24)}}
    return _named(wide, names)


def ops_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "ops-csv")
    files.write_csv(wide_rows(spark, sf_dir), path)
    return path


def route_map_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "route-map")
    rows = tables.dim_route_map(spark, sf_dir).withColumn("route_no", F.concat(F.lit(" "), "route_no", F.lit(" ")))
    files.write_csv(_named(rows, S.ROUTE_MAP_NAMES), path)
    return path


def link_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "links")
    files.write_csv(_named(tables.dim_stop_link(spark, sf_dir), S.LINK_NAMES), path)
    return path


def stop_master_csv(spark: SparkSession, sf_dir: str) -> str:
    """A dated stop master with other spellings and unreadable distances."""
    path = shared_path(spark, "stop-master")
    stops = tables.demand_daily_stop(spark, sf_dir)
    seq = F.substring("stop_id", 2, 3)
    files.write_csv(
        stops.select(
            F.date_format("date", "yyyy-MM-dd").alias("CRTR_DD"),
            F.col("rte_id").alias("ROUTE_ID"),
            F.col("rte_id").alias("RTE_ID"),
            F.col("stop_id").alias("STOPS_ID"),
            F.when(seq == "12", F.lit("")).otherwise(seq).alias("STOPS_SEQ"),
            F.when(seq == "7", F.lit("unknown")).otherwise(F.concat(seq, F.lit("00.5"))).alias("LINK_DIST_M"),
        ),
        path,
    )
    return path


PREDICTION_FILE = {
    "hour": "시간",
    "stop_id": "정류장_ID",
    "stop_seq": "정류장_순서",
    "stop_name": "역명",
    "pass_buses": "통과버스수",
    "pred_board": "예측_승차_총",
    "pred_alight": "예측_하차_총",
    "board_per_bus": "버스당_승차",
    "alight_per_bus": "버스당_하차",
    "onboard_per_bus": "버스당_onboard_추정",
}


def prediction_csv(spark: SparkSession, sf_dir: str) -> str:
    """Prediction files in one folder per date."""
    path = shared_path(spark, "predictions")
    rows = tables.predictions(spark, sf_dir)
    named = rows.select(
        "route_no", "date", *[F.col(n).alias(s) for n, s in PREDICTION_FILE.items()]
    )
    files.write_csv(named, path, ["date"])
    return path


# -- XML pages --------------------------------------------------------------
def _page(rows: DataFrame, keys: list[str], code: Column, total: Column, tags: list[str]) -> DataFrame:
    """One page per key; a page holds the stops of one route."""
    return rows.groupBy(*keys).agg(
        total.cast("string").alias("list_total_count"),
        F.struct(code.alias("CODE"), F.lit("message").alias("MESSAGE")).alias("RESULT"),
        F.collect_list(F.struct(*tags)).alias("row"),
    ).select("list_total_count", "RESULT", "row")


def ops_pages(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "ops-pages")
    _land_ops(tables.ops_wide(spark, sf_dir), path)
    return path


def ops_pages_part(spark: SparkSession, sf_dir: str, path: str, part: str) -> None:
    """Pages of the first dates, or of the later ones with a bus more in every hour that has some."""
    wide = tables.ops_wide(spark, sf_dir)
    if part == "first":
        _land_ops(wide.where(F.col("date") < C.compact_date(F.lit(tables.PREV_UNTIL).cast("date"))), path)
        return
    more = {f"ops_{h:02d}": (F.col(f"ops_{h:02d}").cast("bigint") + 1).cast("string") for h in range(24)}
    _land_ops(wide.where(F.col("date") >= C.compact_date(F.lit(tables.NEW_FROM).cast("date"))).withColumns(more), path)


def _land_ops(wide: DataFrame, path: str) -> None:
    tags = {
        "date": "CRTR_DD",
        "route_key": "RTE_ID",
        "stop_id": "STOPS_ID",
        "stop_seq": "STOPS_SEQ",
        "ops_day": "BUS_OPR",
        **{f"ops_{h:02d}": S.ops_tag(h) for h in range(24)},
    }
    ok = F.lit(S.SUCCESS_CODE)
    pages = _page(_named(wide, tags), ["CRTR_DD", "RTE_ID"], ok, F.count("*"), list(tags.values()))
    xml.land_pages(pages, path, S.OPS_SERVICE)


def daily_pages(spark: SparkSession, sf_dir: str) -> str:
    """Pages of days with more alightings than boardings carry an error status;
    weekend pages announce one row more than they hold."""
    path = shared_path(spark, "daily-pages")
    daily = tables.demand_daily_stop(spark, sf_dir)
    weekend = F.max((F.weekday("date") >= 5).cast("int"))
    code = F.when(
        F.sum("alight_total") > F.sum("board_total"), F.lit("ERROR-500")
    ).otherwise(F.lit(S.SUCCESS_CODE))
    tagged = daily.select(
        "date",
        "board_total",
        "alight_total",
        C.compact_date("date").alias("USE_YMD"),
        F.col("rte_id").alias("RTE_ID"),
        F.col("route_no").alias("RTE_NO"),
        F.col("stop_id").alias("STOPS_ID"),
        F.col("stop_name").alias("SBWY_STNS_NM"),
        F.col("board_total").cast("string").alias("GTON_TNOPE"),
        F.col("alight_total").cast("string").alias("GTOFF_TNOPE"),
        C.compact_date("reg_ymd").alias("REG_YMD"),
    )
    pages = _page(
        tagged, ["USE_YMD", "RTE_NO"], code, F.count("*") + weekend, list(S.DAILY_TAGS.values())
    )
    xml.land_pages(pages, path, S.DAILY_SERVICE)
    return path


def numbered_pages(spark: SparkSession, sf_dir: str, page_rows: int = 5) -> str:
    """Daily pages of five rows, named by route, date and row numbers.

    On every fourth day the first page lands twice and the second is missing, on the
    next the third failed, on the next no page tells a total.
    """
    path = shared_path(spark, "numbered-pages")
    daily = tables.demand_daily_stop(spark, sf_dir)
    rank = F.row_number().over(Window.partitionBy("date", "route_no").orderBy("stop_id"))
    day = F.day("date") % 4
    rows = daily.withColumns({"no": rank, "n": F.count("*").over(Window.partitionBy("date", "route_no")), "kind": day})
    tagged = rows.select(
        "n", "kind",
        F.floor((F.col("no") - 1) / page_rows).alias("page"),
        C.compact_date("date").alias("USE_YMD"),
        F.col("rte_id").alias("RTE_ID"),
        F.col("route_no").alias("RTE_NO"),
        F.col("stop_id").alias("STOPS_ID"),
        F.col("stop_name").alias("SBWY_STNS_NM"),
        F.col("board_total").cast("string").alias("GTON_TNOPE"),
        F.col("alight_total").cast("string").alias("GTOFF_TNOPE"),
        C.compact_date("reg_ymd").alias("REG_YMD"),
    )
    failed = (F.col("kind") == 2) & (F.col("page") == 2)
    pages = tagged.groupBy("USE_YMD", "RTE_NO", "page", "n", "kind").agg(
        F.collect_list(F.struct(*S.DAILY_TAGS.values())).alias("row")
    ).select(
        F.when(F.col("kind") != 3, F.col("n").cast("string")).alias("list_total_count"),
        F.struct(
            F.when(failed, F.lit("ERROR-500")).otherwise(F.lit(S.SUCCESS_CODE)).alias("CODE"), F.lit("message").alias("MESSAGE")
        ).alias("RESULT"),
        "row",
        F.concat_ws("_", "RTE_NO", "USE_YMD", F.col("page") * page_rows + 1, (F.col("page") + 1) * page_rows).alias("name"),
        F.when(F.col("kind") != 1, 1).when(F.col("page") == 0, 2).when(F.col("page") == 1, 0).otherwise(1).alias("copies"),
    )
    landed = pages.withColumn("copies", F.explode(F.sequence(F.lit(0), F.col("copies")))).where("copies > 0").drop("copies")
    xml.land_pages(landed, path, S.DAILY_SERVICE, "name")
    return path


def page_spans_in_batches(spark: SparkSession, sf_dir: str, page_rows: int = 5) -> str:
    """Spans of pages of five rows in three files: the first pages, the others, and late copies on every fourth day."""
    path = shared_path(spark, "page-spans")
    daily = tables.demand_daily_stop(spark, sf_dir)
    whole = daily.groupBy("date", "route_no").agg(F.count("*").alias("total"))
    start = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("total"), F.lit(page_rows).cast("bigint"))).alias("start")
    pages = whole.select("date", "route_no", "total", start).withColumn("n", F.least(F.lit(page_rows), F.col("total") - F.col("start") + 1))
    late = pages.where((F.day("date") % 4 == 1) & (F.col("start") == 1))
    for part in (pages.where("start = 1"), pages.where("start > 1"), late):
        named = part.withColumn("date", C.compact_date("date")).withColumn("n", F.col("n").cast("bigint"))
        named.coalesce(1).write.mode("append").parquet(path)
    return path


def monthly_pages(spark: SparkSession, sf_dir: str) -> str:
    """Odd hours use the second tag spelling."""
    path = shared_path(spark, "monthly-pages")
    monthly = tables.demand_monthly_hourly(spark, sf_dir)
    counts = {}
    for h in range(24):
        for value, tags in (("board_total", S.board_tags(h)), ("alight_total", S.alight_tags(h))):
            counts[tags[h % 2]] = F.sum(F.when(F.col("hour") == h, F.col(value))).cast("string")
    wide = monthly.groupBy("use_ym", "route_no", "stop_id", "stop_name").agg(
        *[c.alias(t) for t, c in counts.items()]
    )
    tagged = wide.select(
        F.col("use_ym").alias("USE_YM"),
        F.col("route_no").alias("RTE_NO"),
        F.col("stop_id").alias("STOPS_ID"),
        F.col("stop_name").alias("SBWY_STNS_NM"),
        F.lit("20240203").alias("REG_YMD"),
        *counts,
    )
    pages = _page(
        tagged,
        ["USE_YM", "RTE_NO"],
        F.lit(S.SUCCESS_CODE),
        F.count("*"),
        [*S.MONTHLY_TAGS.values(), *counts],
    )
    xml.land_pages(pages, path, S.MONTHLY_SERVICE)
    return path
