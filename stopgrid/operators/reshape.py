"""Wide hourly columns to long rows, and rows per unit."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopgrid.functions import columns as C

UNITS_PER_CHUNK = 128


def hour_columns(df: DataFrame, prefix: str, suffix: str = "") -> dict[int, str]:
    """Hour -> column name, for the columns named prefix + two digits + suffix."""
    pattern = re.compile(re.escape(prefix) + r"(\d{1,2})" + re.escape(suffix) + "$")
    found = {int(m.group(1)): name for name in df.columns if (m := pattern.match(name))}
    return dict(sorted(found.items()))


def pack_hours(
    df: DataFrame, hours: dict[int, str], convert: Callable[[Column], Column]
) -> DataFrame:
    """Fold the hour columns into one array `hours` of (hour, ops); no shuffle."""
    entries = [
        F.struct(F.lit(h).alias("hour"), convert(F.col(f"`{c}`")).alias("ops"))
        for h, c in hours.items()
    ]
    return df.withColumn("hours", F.array(*entries)).drop(*hours.values())


def unpivot_hours(
    df: DataFrame,
    hours: dict[int, str],
    ids: Sequence[str],
    convert: Callable[[Column], Column] = C.to_number,
) -> DataFrame:
    """One row per hour column; a missing count stays null and is a double."""
    packed = pack_hours(df.select(*ids, *[f"`{c}`" for c in hours.values()]), hours, convert)
    return packed.select(*ids, F.inline("hours"))


def unpivot_hours_zero(df: DataFrame, hours: dict[int, str], ids: Sequence[str]) -> DataFrame:
    """One row per hour column; a missing or bad count is 0 and whole."""
    return unpivot_hours(df, hours, ids, C.whole_or_zero)


def explode_range(df: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    """One row per number in [start, end).

    Numbers are produced in chunks that are spread over the cluster, so a single
    row with a very long range neither builds one huge array nor stays in one task.
    Chunks are short, so that their number, by which AQE merges tasks, follows the
    number of rows they turn into.
    """
    keys = [c for c in df.columns if df.schema[c].dataType.simpleString() in ("string", "date", "int")]
    return explode_chunks(range_chunks(df, start, end).repartition(*keys, "_from"), name)


def range_chunks(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows times the chunks [_from, _to) of their range."""
    step = F.lit(UNITS_PER_CHUNK).cast("bigint")
    return (
        df.withColumn("_lo", start.cast("bigint"))
        .withColumn("_hi", end.cast("bigint"))
        .where(F.col("_lo") < F.col("_hi"))
        .withColumn("_from", F.explode(F.sequence("_lo", F.col("_hi") - 1, step)))
        .withColumn("_to", F.least(F.col("_from") + step, F.col("_hi")))
        .drop("_lo", "_hi")
    )


def explode_chunks(chunks: DataFrame, name: str) -> DataFrame:
    """One row per number of each chunk."""
    return chunks.withColumn(name, F.explode(F.sequence("_from", F.col("_to") - 1))).drop("_from", "_to")


def calendar(df: DataFrame, start: Column, days: int) -> DataFrame:
    """Every row times `days` dates from `start` times 24 hours."""
    return df.withColumn("date", F.explode(F.sequence(start, F.date_add(start, days - 1)))).withColumn(
        "hour", F.explode(F.sequence(F.lit(0), F.lit(23)))
    )
