"""Queries on column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.plans.registry import plain, query
from stopgrid.plans.twins import day, r, twin
from stopgrid.sources import tables


@query(
    "clip_nonnegative",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour,
            {r('greatest(board - 60, 0)')} as board, {r('greatest(alight - 40, 0)')} as alight from dsh""",
        "dsh",
    ),
)
def clip_nonnegative(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = tables.daily_stop_hour(spark, sf_dir)
    return plain(
        fact.select(
            "route_no", "date", "stop_id", "hour",
            C.clip_zero(F.col("board") - 60).alias("board"),
            C.clip_zero(F.col("alight") - 40).alias("alight"),
        )
    )


@query(
    "safe_ratio",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour,
            case when ops > 1 then {r('board / (ops - 1)')} end as per_bus,
            case when ops > 1 then {r('board / (ops - 1)')} else 0 end as per_bus_or_zero
        from dsh""",
        "dsh",
    ),
)
def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = tables.daily_stop_hour(spark, sf_dir)
    others = F.col("ops") - 1
    return plain(
        fact.select(
            "route_no", "date", "stop_id", "hour",
            C.ratio("board", others).alias("per_bus"),
            C.ratio_or_zero("board", others).alias("per_bus_or_zero"),
        )
    )


@query(
    "scalar_strings",
    """select event_id, concat('route ', upper(trim(concat('  ', event_type, ' ')))) as label,
        regexp_replace(props, '[^0-9]', '', 'g') as digits,
        cast(regexp_extract(props, '([0-9]+)', 1) as int) as number,
        right(concat('HOUR_', lpad(cast(hour(ts) as varchar), 2, '0')), 2) as hour_tag,
        replace(strftime(ts, '%Y-%m-%d'), '-', '') as compact,
        substr(strftime(ts, '%Y%m%d'), 1, 6) as use_ym,
        case when starts_with(event_type, 's') and ends_with(event_type, 'up') then 1 else 0 end as is_signup,
        printf('%s-%02d-%02d', strftime(ts, '%Y%m%d'), hour(ts), user_id % 12) as bus_id
    from events""",
)
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.col("ts").cast("date")
    tag = F.concat(F.lit("HOUR_"), F.lpad(F.hour("ts").cast("string"), 2, "0"))
    kind = F.col("event_type")
    return tables.events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("route "), F.upper(F.trim(F.concat(F.lit("  "), kind, F.lit(" "))))).alias("label"),
        C.digits_only("props").alias("digits"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("number"),
        F.substring(tag, -2, 2).alias("hour_tag"),
        F.regexp_replace(date.cast("string"), "-", "").alias("compact"),
        C.use_ym(date.cast("string")).alias("use_ym"),
        (kind.startswith("s") & kind.endswith("up")).cast("int").alias("is_signup"),
        F.concat_ws(
            "-", C.compact_date(date), C.two_digits(F.hour("ts")), C.two_digits(F.col("user_id") % 12)
        ).alias("bus_id"),
    )


# The event's number written in the ways seen in input files.
TEXT_SQL = """case user_id % 6 when 0 then printf('%d', k) when 1 then printf('%d.7', k)
    when 2 then printf('-%d', k) when 3 then printf(' %d ', k) when 4 then '' else 'n/a' end"""


@query(
    "scalar_numeric_coercion",
    f"""select event_id, text,
        coalesce(try_cast(trim(text) as double), 0) as number,
        cast(trunc(coalesce(try_cast(trim(text) as double), 0)) as bigint) as whole,
        case when regexp_full_match(text, '\\s*\\d+\\s*') then cast(trim(text) as bigint) else 0 end as digits,
        case when regexp_full_match(text, '\\s*[+-]?\\d+\\s*') then cast(trim(text) as bigint) else 0 end as signed,
        cast(round_even(k / cast(4 as double), 0) as bigint) as half_even,
        {r('k / cast(49.5 as double)')} as load
    from (select event_id, k, {TEXT_SQL} as text
        from (select event_id, user_id, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events))""",
)
def scalar_numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    kind = F.col("user_id") % 6
    text = (
        F.when(kind == 0, k.cast("string"))
        .when(kind == 1, F.concat(k.cast("string"), F.lit(".7")))
        .when(kind == 2, F.concat(F.lit("-"), k.cast("string")))
        .when(kind == 3, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
        .when(kind == 4, F.lit(""))
        .otherwise(F.lit("n/a"))
    )
    rows = tables.events(spark, sf_dir).select("event_id", text.alias("text"), k.alias("k"))
    return plain(
        rows.select(
            "event_id",
            "text",
            C.number_or_zero("text").alias("number"),
            C.whole_or_zero("text").alias("whole"),
            C.digits_or_zero("text").alias("digits"),
            C.integer_or_zero("text").alias("signed"),
            F.bround(F.col("k") / 4, 0).cast("bigint").alias("half_even"),
            (F.col("k") / F.lit(S.CROWDED_LOAD)).alias("load"),
        )
    )


@query(
    "scalar_datetime",
    f"""select event_id, {day('date')} as date, {day('date')} as from_compact, {day('date')} as from_iso,
        cast(null as varchar) as from_bad, strftime(date, '%Y%m%d') as compact, strftime(date, '%Y%m') as use_ym,
        cast(hour(ts) as int) as hour, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') as hour_ts,
        cast(isodow(date) - 1 as int) as dow_monday0, cast(dayofweek(date) + 1 as int) as dow_sunday1,
        case when isodow(date) >= 6 then 1 else 0 end as is_weekend, {day('date + 7')} as next_week,
        date_diff('day', date '1970-01-01', date) * 24 + hour(ts) as hour_index,
        strftime(cast(date as timestamp) + to_microseconds(hour(ts) * 3600000000 + 1), '%Y-%m-%d %H:%M:%S.%f') as moment
    from (select *, cast(ts as date) as date from events)""",
)
def scalar_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.events(spark, sf_dir).withColumn("date", F.col("ts").cast("date"))
    compact = C.compact_date("date")
    iso = F.col("date").cast("string")
    return plain(
        rows.select(
            "event_id",
            "date",
            C.parse_date(compact).alias("from_compact"),
            C.parse_date(iso).alias("from_iso"),
            C.parse_date(F.concat(F.lit("x"), iso)).alias("from_bad"),
            compact.alias("compact"),
            C.month_of("date").alias("use_ym"),
            F.hour("ts").alias("hour"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_ts"),
            F.weekday("date").alias("dow_monday0"),
            F.dayofweek("date").alias("dow_sunday1"),
            (F.weekday("date") >= 5).cast("int").alias("is_weekend"),
            F.date_add("date", 7).alias("next_week"),
            C.hour_index("date", F.hour("ts")).alias("hour_index"),
            C.moment("date", F.hour("ts").cast("bigint") * S.US_PER_HOUR + 1).alias("moment"),
        )
    )
