"""Bucketed tables, so that joins on route and stop move nothing.

A table is written once with its rows dealt by (route, stop) into a fixed number of
buckets, a file each. Joins and groups whose keys hold the route and the stop then find
their rows side by side: no exchange stands below them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stopgrid.session import shared_path

STOP = ["route_no", "stop_id"]
BUCKETS = 16
#: Buckets by some of the keys of a join are enough for it.
PART_OF_KEYS = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str] = STOP, buckets: int = BUCKETS) -> str:
    """Write `df` below `path` in buckets by `keys`, one file a bucket, and return the table's name.

    All tables that are to be joined need the same keys and number of buckets. The files
    are an external table of the session's catalog; `drop_table` forgets its name alone.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").option("path", path).saveAsTable(name)
    )
    return name


def bucketed(df: DataFrame, label: str, keys: Sequence[str] = STOP, buckets: int = BUCKETS) -> DataFrame:
    """`df` written in buckets to the shared folder and read back from there."""
    spark = df.sparkSession
    use_buckets(spark)
    return spark.table(write_bucketed(df, shared_path(spark, label), keys, buckets))


def use_buckets(spark: SparkSession) -> None:
    """Let the session join tables whose buckets go by some of the join's keys as they lie."""
    spark.conf.set(*PART_OF_KEYS)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"drop table if exists {name}")
