"""Session settings and the shared folder for tables written between steps."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_base: dict[str, str] = {}
_stored: list[str] = []


def build_session(app_name: str = "stopgrid", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder that every executor can reach.

    The folder is the session's ``spark.checkpoint.dir``. Only a local-mode
    session, where driver and executors are one process, may fall back to a
    temporary folder, which is dropped when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base.get("dir")
        if base is None:
            base = _local_base["dir"] = tempfile.mkdtemp(prefix="stopgrid-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    return os.path.join(base, "stopgrid", f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read back from there.

    Whoever is done with the tables of a job removes them: see `releasing`.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    _stored.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Removes the tables stored inside the block when it ends, also by an error.

    For jobs that write their result; a frame that reads such a table must not leave
    the block.
    """
    before = len(_stored)
    try:
        yield
    finally:
        for path in _stored[before:]:
            remove_path(spark, path)
        del _stored[before:]


def on_file_system(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table this session wrote between two steps."""
    fs, p = on_file_system(spark, path)
    fs.delete(p, True)
