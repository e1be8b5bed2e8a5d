"""Queries on model features, windows and the demand model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators import features
from stopgrid.plans.registry import plain, query
from stopgrid.plans.twins import day, r, twin
from stopgrid.session import stored
from stopgrid.sources import tables

WINDOW_SERIES = ["split", "route_no", "stop_id"]


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_split(
        features.demand_features(tables.daily_stop_hour(spark, sf_dir)), tables.SPLITS
    )


@query(
    "demand_features",
    twin(
        f"""select route_no, stop_id, {day()} as date, hour_index, hour, cast(dow as int) as dow, is_weekend, stop_seq,
            {r('distance')} as distance, pass_buses, {r('headway_min')} as headway_min, target_per_bus,
            {r('y_board')} as y_board, {r('y_alight')} as y_alight,
            strftime(cast(features.date as timestamp) + to_hours(hour), '%Y-%m-%d %H:%M:%S.%f') as ts,
            cast(dense_rank() over (partition by route_no order by stop_id) - 1 as int) as stop_idx
        from features""",
        "features",
    ),
)
def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.demand_features(tables.daily_stop_hour(spark, sf_dir))
    stamped = rows.withColumn("ts", C.moment("date", F.col("hour").cast("bigint") * S.US_PER_HOUR))
    return plain(features.index_stops(stamped))


@query(
    "stop_index",
    twin(
        """select route_no, stop_id, cast(dense_rank() over (partition by route_no order by stop_id) - 1 as int) as stop_idx
        from (select distinct route_no, stop_id from passes)""",
        "passes",
    ),
)
def stop_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = tables.demand_daily_stop(spark, sf_dir)
    return plain(features.stop_index(stops))


@query(
    "ts_split",
    twin(
        f"""select route_no, stop_id, {day()} as date, hour, split from split_rows""",
        "split_rows",
    ),
)
def ts_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_rows(spark, sf_dir).select("route_no", "stop_id", "date", "hour", "split"))


@query(
    "headway_feature",
    twin(
        f"""select route_no, {day()} as date, stop_id, hour, cast(ops * 10 - 10 as double) as pass_buses,
            {r("least(greatest(case when ops > 1 then cast(60 as double) / (ops * 10 - 10) else 60 end, 2), 60)")} as headway_min
        from dsh""",
        "dsh",
    ),
)
def headway_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.daily_stop_hour(spark, sf_dir).withColumn(
        "pass_buses", (F.col("ops") * 10 - 10).cast("double")
    )
    return plain(
        rows.select(
            "route_no", "date", "stop_id", "hour", "pass_buses",
            C.capped_headway("pass_buses").alias("headway_min"),
        )
    )


@query(
    "feature_minmax",
    twin(
        f"""select route_no, feature, {r('min(v)')} as min, {r('max(v)')} as max,
            {r('case when max(v) = min(v) then 1 else max(v) - min(v) end')} as range
        from (
            select route_no, unnest(['hour', 'dow', 'is_weekend', 'stop_seq', 'distance', 'pass_buses',
                    'headway_min', 'target_per_bus']) as feature,
                unnest([hour::double, dow::double, is_weekend::double, stop_seq::double, distance, pass_buses,
                    headway_min, target_per_bus]) as v
            from (select *, count(*) over s as n, lead(hour_index) over (s order by hour_index) as following
                from split_rows where split = 'train' window s as (partition by route_no, stop_id))
            where n > 24 and following is not null)
        group by route_no, feature""",
        "split_rows",
    ),
)
def feature_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _rows(spark, sf_dir).where("split = 'train'")
    return plain(features.minmax_long(features.feature_minmax(train)))


def _window_sums() -> list[Column]:
    def total(name: str) -> Column:
        return F.aggregate("past", F.lit(0.0), lambda acc, x: acc + x[name]).alias(f"sum_{name}")

    position = F.aggregate(
        F.transform("past", lambda x, i: x["hour"] * (i + 1)), F.lit(0.0), lambda acc, x: acc + x
    )
    return [*[total(f) for f in features.FEATURES], position.alias("ordered_hours")]


PAST = """window w as (partition by split, route_no, stop_id order by hour_index
    rows between 24 preceding and 1 preceding)"""


def _past_sums(source: str, value) -> str:
    sums = ", ".join(f"sum({value(f)}) over w as sum_{f}" for f in features.FEATURES)
    hours = value("hour")
    ordered = f"""list_sum(list_transform(list({hours}) over w, lambda x, i: x * i)) as ordered_hours"""
    outer = ", ".join(f"{r(f'sum_{f}')} as sum_{f}" for f in features.FEATURES)
    return f"""select split, route_no, stop_id, date, hour, {r('y_board')} as y_board, {outer},
            {r('ordered_hours')} as ordered_hours
        from (select split, route_no, stop_id, {day()} as date, hour, y_board, count(*) over w as n, {sums}, {ordered}
            from {source} {PAST}) where n = 24"""


@query("sequence_windows", twin(_past_sums("split_rows", lambda f: f), "split_rows"))
def sequence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = features.sequence_windows(_rows(spark, sf_dir), WINDOW_SERIES)
    return plain(
        windows.select("split", "route_no", "stop_id", "date", "hour", "y_board", *_window_sums())
    )


MINMAX = """minmax as (select route_no, {bounds} from (
        select *, count(*) over s as n, lead(hour_index) over (s order by hour_index) as following
        from split_rows where split = 'train' window s as (partition by route_no, stop_id))
    where n > 24 and following is not null group by route_no)""".format(
    bounds=", ".join(
        f"min({f})::double as {f}_min, max({f})::double as {f}_max" for f in features.FEATURES
    )
)


def _scaled(f: str) -> str:
    return (
        f"(({f} - {f}_min) / case when {f}_max = {f}_min then cast(1 as double) else {f}_max - {f}_min end)"
    )


@query(
    "scaled_windows",
    twin(
        _past_sums("(select s.*, m.* exclude (route_no) from split_rows s join minmax m on m.route_no = s.route_no)", _scaled),
        "split_rows",
        extra=MINMAX,
    ),
)
def scaled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(_rows(spark, sf_dir), "model-features")
    minmax = features.feature_minmax(rows.where("split = 'train'"))
    scaled = features.scaled_windows(rows, minmax, WINDOW_SERIES)
    hour = (F.col("hour_index") % 24).cast("int").alias("hour")
    return plain(
        scaled.select("split", "route_no", "stop_id", "date", hour, "y_board", *_window_sums())
    )


def _model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows as vectors, written once, as every fit reads them."""
    rows = stored(_rows(spark, sf_dir), "model-features")
    minmax = features.feature_minmax(rows.where("split = 'train'"))
    windows = features.sequence_windows(features.scale_features(rows, minmax), WINDOW_SERIES)
    return stored(features.model_input(windows), "model-windows")


@query(
    "demand_model_scores",
    twin(
        f"""select split, count(*) as windows, {r('avg(y_board)')} as mean_board, {r('avg(y_alight)')} as mean_alight,
            split = 'train' as checked, split = 'train' as beats_mean
        from (select *, count(*) over (partition by split, route_no, stop_id order by hour_index
                rows between 24 preceding and 1 preceding) as n from split_rows)
        where n = 24 group by split""",
        "split_rows",
    ),
)
def demand_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and mean targets per split, and whether the fitted model beats the mean.

    The events hold no pattern, so only the split it was fitted on must be beaten.

    """
    errors = features.demand_errors(features.demand_scores(_model_rows(spark, sf_dir)))
    checked = F.col("split") == "train"
    beaten = (F.col("mse_board") < F.col("variance_board")) & (F.col("mse_alight") < F.col("variance_alight"))
    return plain(
        errors.select(
            "split", "windows", "mean_board", "mean_alight", checked.alias("checked"), (checked & beaten).alias("beats_mean")
        )
    )


ROUNDS = 8


@query(
    "absolute_model_scores",
    twin(
        """select split, count(*) as windows, split = 'val' as checked, split = 'val' as rounds_kept, split = 'val' as not_worse
        from (select *, count(*) over (partition by split, route_no, stop_id order by hour_index
                rows between 24 preceding and 1 preceding) as n from split_rows)
        where n = 24 group by split""",
        "split_rows",
    ),
)
def absolute_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fit on absolute errors: windows, its rounds within bounds, and its validation error not above least squares'."""
    rows = features.with_levels(_model_rows(spark, sf_dir))
    train, validation = (rows.where(F.col("split") == s) for s in ("train", "val"))
    fits = [features.fit_absolute(train, validation, t, ROUNDS, 2) for t in features.TARGETS]
    kept = all(1 <= len(f.errors) - 1 <= ROUNDS for f in fits)
    fine = all(f.error is not None and f.error <= f.errors[0] for f in fits)
    checked = F.col("split") == "val"
    return plain(
        rows.groupBy("split").agg(F.count("*").alias("windows")).select(
            "split", "windows", checked.alias("checked"), (checked & F.lit(kept)).alias("rounds_kept"), (checked & F.lit(fine)).alias("not_worse")
        )
    )
