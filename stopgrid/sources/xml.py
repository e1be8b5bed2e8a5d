"""Landed XML pages of the open-data services.

A page is one element named after its service with a total count, a status and at
most a thousand `row` elements. One record is one page, so the pages of all days
are read, checked and unfolded in a single scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators.merge import ORIGIN

ROW_TAGS = {
    S.OPS_SERVICE: [*S.OPS_TAGS.values(), *[S.ops_tag(h) for h in range(24)]],
    S.DAILY_SERVICE: list(S.DAILY_TAGS.values()),
    S.MONTHLY_SERVICE: [
        *S.MONTHLY_TAGS.values(),
        *[t for h in range(24) for t in (*S.board_tags(h), *S.alight_tags(h))],
    ],
}


def page_schema(service: str) -> T.StructType:
    text = T.StringType()
    row = T.StructType([T.StructField(t, text) for t in ROW_TAGS[service]])
    status = T.StructType([T.StructField("CODE", text), T.StructField("MESSAGE", text)])
    return T.StructType(
        [
            T.StructField("list_total_count", text),
            T.StructField("RESULT", status),
            T.StructField("row", T.ArrayType(row)),
        ]
    )


def read_pages(spark: SparkSession, path: str | list[str], service: str) -> DataFrame:
    """One record per page: total (null where it is not told), code, message, rows, file."""
    pages = (
        spark.read.format("xml")
        .option("rowTag", service)
        .schema(page_schema(service))
        .load(path)
    )
    announced = F.when(F.col("list_total_count").isNotNull(), C.digits_or_zero("list_total_count"))
    return pages.select(
        announced.alias("total"),
        F.col("RESULT.CODE").alias("code"),
        F.col("RESULT.MESSAGE").alias("message"),
        F.col("row").alias("rows"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            "_metadata.file_modification_time", "_metadata.file_path", F.monotonically_increasing_id().alias("page")
        ).alias("_page"),
    )


def is_error(code: Column | str = "code") -> Column:
    """A status other than success; pages without status are accepted."""
    c = F.col(code) if isinstance(code, str) else code
    return F.coalesce((c != "") & (c != S.SUCCESS_CODE), F.lit(False))


def error_pages(pages: DataFrame) -> DataFrame:
    return pages.where(is_error()).select("file", "code", "message", F.size("rows").alias("n_rows"))


def _rows(pages: DataFrame) -> DataFrame:
    """Records of the pages without error, with their place among all pages."""
    rows = pages.where(~is_error()).select("_page", F.posexplode("rows").alias("_at", "_r"))
    return rows.select(F.struct("_page", "_at").alias(ORIGIN), "_r.*")


def _origin(keep: bool) -> list[str]:
    return [ORIGIN] if keep else []


def _text(tag: str) -> Column:
    return F.coalesce(F.col(tag), F.lit(""))


def ops_rows(pages: DataFrame, origin: bool = False) -> DataFrame:
    """Wide operations records; an hour that is not plain digits counts 0."""
    return _rows(pages).select(
        _text(S.OPS_TAGS["date"]).alias("date"),
        _text(S.OPS_TAGS["rte_id"]).alias("rte_id"),
        _text(S.OPS_TAGS["stop_id"]).alias("stop_id"),
        C.to_number(S.OPS_TAGS["stop_seq"]).try_cast("int").alias("stop_seq"),
        F.coalesce(F.col(S.OPS_TAGS["ops_day"]), F.lit("0")).alias("ops_day"),
        *[C.digits_or_zero(S.ops_tag(h)).alias(f"ops_{h:02d}") for h in range(24)],
        *_origin(origin),
    )


def daily_rows(pages: DataFrame, origin: bool = False) -> DataFrame:
    """Daily boardings and alightings per stop; with `origin` also where each row was read."""
    tag = S.DAILY_TAGS
    return _rows(pages).select(
        C.parse_date(tag["date"]).alias("date"),
        _text(tag["rte_id"]).alias("rte_id"),
        _text(tag["route_no"]).alias("route_no"),
        _text(tag["stop_id"]).alias("stop_id"),
        _text(tag["stop_name"]).alias("stop_name"),
        C.integer_or_zero(tag["board_total"]).alias("board_total"),
        C.integer_or_zero(tag["alight_total"]).alias("alight_total"),
        C.parse_date(tag["reg_ymd"]).alias("reg_ymd"),
        *_origin(origin),
    )


def monthly_rows(pages: DataFrame, origin: bool = False) -> DataFrame:
    """24 hour rows per stop and month; of two tag spellings the first present counts,
    even where it is blank."""
    tag = S.MONTHLY_TAGS

    def count(tags: tuple[str, str]) -> Column:
        return C.integer_or_zero(F.coalesce(*[F.col(t) for t in tags]))

    hours = F.array(
        *[
            F.struct(
                F.lit(h).alias("hour"),
                count(S.board_tags(h)).alias("board_total"),
                count(S.alight_tags(h)).alias("alight_total"),
            )
            for h in range(24)
        ]
    )
    return _rows(pages).select(
        _text(tag["use_ym"]).alias("use_ym"),
        _text(tag["route_no"]).alias("route_no"),
        _text(tag["stop_id"]).alias("stop_id"),
        _text(tag["stop_name"]).alias("stop_name"),
        C.parse_date(tag["reg_ymd"]).alias("reg_ymd"),
        *_origin(origin),
        F.inline(hours),
    )


#: A landed page's name, or its folder's: date or month and the numbers of its rows, behind
#: the route or in its folder. The first page may go without numbers.
PAGE_NAME = r"(?:([^/_=]+)[/_])?([0-9]{6}(?:[0-9]{2})?)(?:_([0-9]+)_[0-9]+)?(?:/[^/]+)?\.xml$"


def page_spans(pages: DataFrame, date_tag: str, route_tag: str | None = None) -> DataFrame:
    """Per page its date, route, announced total, and the row numbers `start` to `end` that it holds.

    A page belongs to the date and route of its first row, an empty or failed one to
    those in its file's name. It holds as many rows as it has, from the number in its
    name on; a failed page holds none. Without a number in the name `start` is null,
    and `digest` tells whether it is the same page as another. Without a route tag
    pages belong to a date alone.
    """
    first = F.try_element_at("rows", F.lit(1))
    date, route, number = (F.nullif(F.regexp_extract("file", PAGE_NAME, i), F.lit("")) for i in (2, 1, 3))
    start = F.when(date.isNotNull(), F.coalesce(number.cast("bigint"), F.lit(1).cast("bigint")))
    n = F.when(is_error(), F.lit(0)).otherwise(F.size(F.coalesce("rows", F.array()))).cast("bigint")
    return pages.select(
        F.coalesce(first[date_tag], date).alias("date"),
        (F.coalesce(first[route_tag], route) if route_tag else F.lit(None).cast("string")).alias("route_no"),
        "total",
        "file",
        is_error().alias("failed"),
        start.alias("start"),
        n.alias("n"),
        F.xxhash64("rows").alias("digest"),
    )


def page_coverage(spans: DataFrame) -> DataFrame:
    """Per date and route the rows that landed, and the gaps (first, last) in what was announced.

    Ranges are merged in their order, so a page that landed twice counts once and
    cannot stand for a missing one, and a failed page is made good by a later copy.
    Pages without a number are told apart by content and come after all others. A
    total that no page tells leaves a gap without end.
    """
    keys = ["date", "route_no"]
    ranged = F.col("start").isNotNull() & (F.col("n") > 0)
    numbered = spans.where(ranged).select(*keys, "start", (F.col("start") + F.col("n") - 1).alias("end"))
    before = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    merged = numbered.withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0)))
    hole = F.struct((F.col("seen") + 1).alias("first"), (F.col("start") - 1).alias("last"))
    ranges = merged.groupBy(*keys).agg(
        F.max("end").alias("end"),
        F.sum(F.greatest(F.col("end") - F.greatest("seen", F.col("start") - 1), F.lit(0))).alias("covered"),
        F.sort_array(F.collect_list(F.when(F.col("start") > F.col("seen") + 1, hole))).alias("holes"),
    )
    loose = (
        spans.where(F.col("start").isNull()).groupBy(*keys, "digest").agg(F.max("n").alias("n"))
        .groupBy(*keys).agg(F.sum("n").alias("loose"))
    )
    told = spans.groupBy(*keys).agg(
        F.max("total").alias("total"),
        F.count("*").alias("pages"),
        F.sum(F.col("failed").cast("int")).alias("errors"),
        F.sum((F.col("failed") & F.col("start").isNull()).cast("int")).alias("lost"),
    )

    def same(name: str) -> Column:
        return F.col("told.date").eqNullSafe(F.col(f"{name}.date")) & F.col("told.route_no").eqNullSafe(F.col(f"{name}.route_no"))

    joined = told.alias("told").join(ranges.alias("ranges"), same("ranges"), "left").join(loose.alias("loose"), same("loose"), "left")
    landed_last = F.coalesce("end", F.lit(0)) + F.coalesce("loose", F.lit(0))
    tail = F.struct((landed_last + 1).alias("first"), F.col("total").alias("last"))
    open_ended = F.when(F.col("total").isNull() | (landed_last < F.col("total")), F.array(tail))
    gaps = F.concat(F.coalesce("holes", F.array().cast("array<struct<first: bigint, last: bigint>>")), F.coalesce(open_ended, F.array()))
    return joined.select(
        "told.date", "told.route_no", "total",
        (F.coalesce("covered", F.lit(0)) + F.coalesce("loose", F.lit(0))).alias("landed"),
        "pages", "errors", "lost", gaps.alias("gaps"),
    )


def page_completeness(pages: DataFrame, date_tag: str, route_tag: str | None = None) -> DataFrame:
    """Landed rows against the announced total per date and route, and whether none is missing.

    A failed page whose rows have no numbers cannot be made good, so its date and route
    are not complete.
    """
    whole = (F.size("gaps") == 0) & (F.col("lost") == 0)
    return page_coverage(page_spans(pages, date_tag, route_tag)).select(
        "date", "route_no", "total", "landed", "pages", "errors", whole.cast("int").alias("complete")
    )


def page_gaps(pages: DataFrame, date_tag: str, route_tag: str | None = None) -> DataFrame:
    """Announced rows that no page holds: per date and route first and last number of each gap."""
    covered = page_coverage(page_spans(pages, date_tag, route_tag))
    return covered.select("date", "route_no", "total", F.inline("gaps")).withColumnsRenamed(
        {"first": "first_missing", "last": "last_missing"}
    )


def land_pages(df: DataFrame, path: str, service: str, name: str | None = None) -> None:
    """Write page records (list_total_count, RESULT, row) as XML files.

    With `name`, a column of names like `0017_20250601_1_500`, each page lies in a
    folder of its own.
    """
    writer = df.write.format("xml").option("rowTag", service).option("rootTag", "pages").mode("overwrite")
    (writer.partitionBy(name) if name else writer).save(path)
