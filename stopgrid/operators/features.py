"""Model features, history windows, scaling, and the demand model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C

FEATURES = [
    "hour",
    "dow",
    "is_weekend",
    "stop_seq",
    "distance",
    "pass_buses",
    "headway_min",
    "target_per_bus",
]
SERIES = ["route_no", "stop_id"]
TARGETS = ("y_board", "y_alight")
#: Rounds of the absolute fit at most, and how many without a better one end it.
MAX_ROUNDS = 100
PATIENCE = 5
#: Distances below it count as so many passengers.
NEAR = 0.01
CHUNK_HOURS = 24 * 32

Split = dict[str, tuple[str | dt.date, str | dt.date]]


def stop_index(fact: DataFrame) -> DataFrame:
    """Number the stops of each route from 0, in numeric order where ids are numbers.

    The rank runs over the distinct stops of one route, not over the fact rows.
    """
    stops = fact.select(*SERIES).distinct()
    order = Window.partitionBy("route_no").orderBy(
        F.asc_nulls_last(F.col("stop_id").try_cast("bigint")), "stop_id"
    )
    return stops.withColumn("stop_idx", F.dense_rank().over(order) - 1)


def index_stops(rows: DataFrame) -> DataFrame:
    """Rows with the number of their stop."""
    return rows.join(stop_index(rows), SERIES, "left")


def demand_features(fact: DataFrame) -> DataFrame:
    """Feature columns and the two targets for every stop hour.

    A missing or zero link distance takes the mean of the route's usable ones, or
    300 m where the table has no distance at all.
    """
    rows = fact.withColumns(
        {
            "pass_buses": C.clip_zero(F.coalesce(F.col("ops"), F.lit(0)).cast("double")),
            "y_board": C.clip_zero(F.coalesce(F.col("board"), F.lit(0.0))),
            "y_alight": C.clip_zero(F.coalesce(F.col("alight"), F.lit(0.0))),
            "hour_index": C.hour_index("date", "hour"),
            "dow": F.weekday("date"),
        }
    )
    if "link_distance_m" in fact.columns:
        usable = F.when(F.col("link_distance_m") != 0, F.col("link_distance_m"))
        means = fact.groupBy("route_no").agg(F.avg(usable).alias("mean_link"))
        rows = rows.join(means, "route_no", "left").withColumn(
            "distance", F.coalesce(usable, F.col("mean_link"), F.lit(S.DEFAULT_LINK_M))
        )
    else:
        rows = rows.withColumn("distance", F.lit(S.DEFAULT_LINK_M))
    return rows.withColumns(
        {
            "is_weekend": (F.col("dow") >= 5).cast("int"),
            "headway_min": C.capped_headway("pass_buses"),
            "target_per_bus": F.lit(S.CROWDED_LOAD),
        }
    ).select(*SERIES, "date", "hour_index", *FEATURES, "y_board", "y_alight")


def split_of(date: Column | str, bounds: Split) -> Column:
    """Name of the first date window (inclusive) a row falls in, else null."""
    col = F.col(date) if isinstance(date, str) else date
    name = F.lit(None).cast("string")
    for label, (first, last) in reversed(list(bounds.items())):
        name = F.when(
            col.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(label)
        ).otherwise(name)
    return name


def with_split(rows: DataFrame, bounds: Split) -> DataFrame:
    """Rows inside any window, with its name; the range filter reaches the scan."""
    inside = F.lit(False)
    for first, last in bounds.values():
        inside = inside | F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return rows.where(inside).withColumn("split", split_of("date", bounds))


# -- history windows --------------------------------------------------------
def _as_doubles(names: list[str]) -> Column:
    return F.struct(*[F.col(n).cast("double").alias(n) for n in names])


def sequence_windows(
    rows: DataFrame,
    series: list[str],
    order: str = "hour_index",
    features: list[str] = FEATURES,
    length: int = S.SEQUENCE_LENGTH,
    chunk: int = CHUNK_HOURS,
) -> DataFrame:
    """Rows with the `length` rows before them in their series, as an array `past`.

    Rows count, not hours; rows with a shorter past are left out. A series is cut
    into chunks of `chunk` hours, so that even a series holding most rows is spread
    over many tasks. Each chunk is handed the last `length` rows before it, which
    are found among the short tails of the earlier chunks.
    """
    chunked = rows.withColumn("_chunk", F.floor(F.col(order) / chunk)).withColumn(
        "_x", _as_doubles(features)
    )
    group = [*series, "_chunk"]
    last_first = Window.partitionBy(*group).orderBy(F.desc(order))
    tails = (
        chunked.select(*group, order, "_x")
        .withColumn("_n", F.row_number().over(last_first))
        .where(F.col("_n") <= length)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct(order, "_x"))).alias("_tail"))
    )
    earlier = Window.partitionBy(*series).orderBy("_chunk").rowsBetween(-length, -1)
    joined_tails = F.flatten(F.collect_list("_tail").over(earlier))
    carried = (
        tails.withColumn("_all", joined_tails)
        .where(F.size("_all") > 0)
        .select(
            *group,
            F.inline(F.slice("_all", F.greatest(F.size("_all") - length + 1, F.lit(1)), length)),
        )
        .withColumn("_own", F.lit(False))
    )
    own = chunked.withColumn("_own", F.lit(True))
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(-length, -1)
    return (
        own.unionByName(carried, allowMissingColumns=True)
        .withColumn("past", F.collect_list("_x").over(before))
        .where(F.col("_own") & (F.size("past") == length))
        .drop("_chunk", "_x", "_own")
    )


def feature_minmax(train: DataFrame, series: list[str] = SERIES, order: str = "hour_index",
                   features: list[str] = FEATURES, length: int = S.SEQUENCE_LENGTH) -> DataFrame:
    """Lowest and highest value of each feature per route over all training windows.

    The rows in at least one window are those of series with more than `length`
    rows, but for each series' last row; so no window has to be built.
    """
    ends = train.groupBy(*series).agg(F.max(order).alias("_last"), F.count("*").alias("_rows"))
    used = train.join(ends.where(F.col("_rows") > length), series).where(F.col(order) < F.col("_last"))
    lows = [F.min(F.col(f).cast("double")).alias(f"{f}_min") for f in features]
    highs = [F.max(F.col(f).cast("double")).alias(f"{f}_max") for f in features]
    return used.groupBy("route_no").agg(*lows, *highs)


def minmax_long(minmax: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """One row per route and feature with min, max and the range to divide by."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f"{f}_min").alias("min"),
                F.col(f"{f}_max").alias("max"),
            )
            for f in features
        ]
    )
    span = F.col("max") - F.col("min")
    return minmax.select("route_no", F.inline(entries)).withColumn(
        "range", F.when(span == 0, F.lit(1.0)).otherwise(span)
    )


def scale_features(rows: DataFrame, minmax: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Each feature as (x - min) / range of its route; a zero range counts as 1."""

    def scaled(f: str) -> Column:
        low, span = F.col(f"{f}_min"), F.col(f"{f}_max") - F.col(f"{f}_min")
        return (F.col(f) - low) / F.when(span == 0, F.lit(1.0)).otherwise(span)

    return (
        rows.join(minmax, "route_no")
        .withColumns({f: scaled(f) for f in features})
        .drop(*[f"{f}_{end}" for f in features for end in ("min", "max")])
    )


def scaled_windows(
    rows: DataFrame, minmax: DataFrame, series: list[str], features: list[str] = FEATURES
) -> DataFrame:
    """Windows of scaled values; rows are scaled once, before each enters 24 windows."""
    return sequence_windows(scale_features(rows, minmax, features), series, features=features)


# -- demand model -----------------------------------------------------------
def model_input(windows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """The flattened window as one vector column."""
    from pyspark.ml.functions import array_to_vector

    flat = F.flatten(F.transform("past", lambda r: F.array(*[r[f] for f in features])))
    return windows.withColumn("x", array_to_vector(flat)).drop("past")


def stop_levels(train: DataFrame, targets: list[str]) -> DataFrame:
    """Each stop's own mean of the targets: its place in the model, however many stops there are."""
    return train.groupBy(*SERIES).agg(*[F.avg(t).alias(f"level_{t}") for t in targets])


def fit_demand_model(train: DataFrame, target: str, weight: str | None = None):
    """Linear model of a target's distance from its stop's level; the normal equations need a single pass."""
    from pyspark.ml.regression import LinearRegression

    squares = LinearRegression(
        featuresCol="x", labelCol=f"gap_{target}", predictionCol=f"move_{target}",
        solver="normal", regParam=0.01, maxIter=1,
    )
    return (squares.setWeightCol(weight) if weight else squares).fit(train)


def predicted(model, rows: DataFrame, target: str) -> DataFrame:
    """Rows with the target's level moved by the model, never below 0."""
    return model.transform(rows).withColumn(
        target.replace("y_", "yhat_"), C.clip_zero(F.col(f"level_{target}") + F.col(f"move_{target}"))
    )


def absolute_error(model, rows: DataFrame, target: str) -> float | None:
    """Mean absolute error of a model's predictions, None without rows."""
    gap = F.abs(F.col(target) - F.col(target.replace("y_", "yhat_")))
    return predicted(model, rows, target).agg(F.avg(gap)).first()[0]


class AbsoluteFit(NamedTuple):
    """A model, the error it was picked for, and the errors of all rounds; the first is that of least squares."""

    model: object
    error: float | None
    errors: list[float | None]


def fit_absolute(
    train: DataFrame, validation: DataFrame, target: str, rounds: int = MAX_ROUNDS, patience: int = PATIENCE
) -> AbsoluteFit:
    """The linear model of least absolute error, by least squares over and over with new weights.

    A round weighs each training row by one over its distance from the last round's
    prediction (a small one counts as `NEAR`), which turns squares into absolute values,
    and takes one pass over the training rows. The error that decides is the absolute one
    of the validation rows: the best round is kept, and `patience` rounds without a better
    one end the fit. Without validation rows the training rows decide.
    """
    judge = train if validation.isEmpty() else validation
    model = fit_demand_model(train, target)
    best, best_error = model, absolute_error(model, judge, target)
    errors, since_best = [best_error], 0
    while len(errors) <= rounds and since_best < patience and best_error is not None:
        away = F.abs(F.col(f"gap_{target}") - F.col(f"move_{target}"))
        weighed = model.transform(train).withColumn("_w", F.lit(1.0) / F.greatest(away, F.lit(NEAR))).drop(f"move_{target}")
        model = fit_demand_model(weighed, target, "_w")
        errors.append(absolute_error(model, judge, target))
        if errors[-1] < best_error:
            best, best_error, since_best = model, errors[-1], 0
        else:
            since_best += 1
    return AbsoluteFit(best, best_error, errors)


def with_levels(rows: DataFrame, train_split: str = "train", targets: Sequence[str] = TARGETS) -> DataFrame:
    """Rows with each target's level at their stop and their distance from it.

    A stop that has no training rows takes the level of all.
    """
    train = rows.where(F.col("split") == train_split)
    overall = train.agg(*[F.avg(t).alias(t) for t in targets]).first()
    rows = rows.join(stop_levels(train, list(targets)), SERIES, "left")
    for t in targets:
        rows = rows.withColumn(f"level_{t}", F.coalesce(F.col(f"level_{t}"), F.lit(overall[t])))
        rows = rows.withColumn(f"gap_{t}", F.col(t) - F.col(f"level_{t}"))
    return rows


def demand_scores(
    rows: DataFrame, train_split: str = "train", loss: str = "squared", validation_split: str = "val",
    rounds: int = MAX_ROUNDS, patience: int = PATIENCE,
) -> DataFrame:
    """Rows of all splits with yhat_board and yhat_alight, never negative.

    `rows` holds the vector column x and the split; levels and models are fitted on
    the training split. With the absolute loss the validation split picks the round. Every
    fit reads the rows anew, so they are best a stored table.
    """
    if loss not in ("squared", "absolute"):
        raise ValueError(f"unknown loss {loss}")
    rows = with_levels(rows, train_split)
    train, validation = (rows.where(F.col("split") == s) for s in (train_split, validation_split))
    models = [
        fit_demand_model(train, t) if loss == "squared" else fit_absolute(train, validation, t, rounds, patience).model for t in TARGETS
    ]
    for t, model in zip(TARGETS, models):
        rows = predicted(model, rows, t)
    return rows.drop(*[f"{kind}_{t}" for kind in ("level", "gap", "move") for t in TARGETS])


def demand_errors(scores: DataFrame) -> DataFrame:
    """Mean, mean absolute and mean squared error per split and target.

    `variance` is the squared error of always saying the split's mean.
    """
    def errors(y: str, yhat: str, name: str) -> list[Column]:
        gap = F.col(y) - F.col(yhat)
        return [
            F.avg(y).alias(f"mean_{name}"),
            F.avg(F.abs(gap)).alias(f"mae_{name}"),
            F.avg(gap * gap).alias(f"mse_{name}"),
            F.var_pop(y).alias(f"variance_{name}"),
        ]

    return scores.groupBy("split").agg(
        F.count("*").alias("windows"),
        *errors("y_board", "yhat_board", "board"),
        *errors("y_alight", "yhat_alight", "alight"),
    )
