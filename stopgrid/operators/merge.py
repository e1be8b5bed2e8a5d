"""Keyed upserts, the run ledger, source preference and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.session import on_file_system, remove_path, shared_path, stored

#: Where a row was read: later files, and in a file later rows, come after.
ORIGIN = "_origin"


# -- upserts ----------------------------------------------------------------
def with_origin(rows: DataFrame) -> DataFrame:
    """Rows as a file scan gives them, with their place among all files: by time, path and row.

    As the order of an upsert it lets the last writer win. Within a task the numbers
    grow as rows are read, and a file's parts are told apart by where they begin.
    """
    return with_row(rows.withColumn(ORIGIN, file_place()))


def file_place() -> Column:
    return F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")


def with_row(rows: DataFrame) -> DataFrame:
    """The origin completed by the order in which rows are read; a stream does this per batch."""
    return rows.withColumn(ORIGIN, F.struct(F.col(ORIGIN).alias("file"), F.monotonically_increasing_id().alias("row")))


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by `order` (null sorts last)."""
    latest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_first(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def merge_upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Existing rows replaced or extended by the incoming ones, key by key.

    `order` decides between incoming rows of one key; existing keys are unique. A
    null in a key never matches, as in a database.
    """
    fresh = last_per_key(incoming, keys, order) if order else incoming
    fresh = fresh.select(*existing.columns)
    kept = existing.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(fresh)


def only_partitions(table: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partitioned table in the partitions that occur in `wanted`.

    The smallest and the largest value of each column become a filter, so that
    folders outside are not read at all; the semi join keeps the selection exact.
    """
    if not columns:
        return table
    ends = wanted.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).first()
    for c in columns:
        table = table.where(F.col(c).between(F.lit(ends[f"low_{c}"]), F.lit(ends[f"high_{c}"])))
    return table.join(wanted.select(*columns).distinct(), list(columns), "left_semi")


def upsert_table(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    order: Sequence[str],
) -> None:
    """Upsert into a Parquet table, reading and rewriting only touched partitions.

    `order` says which of several incoming rows of one key is the last; that one is
    taken. A column of `with_origin` may be among them and is not stored. Incoming
    rows are computed once, beside the table. Touched partitions are replaced when the
    write commits, so the same files may be read for it. The first write of a table
    has nothing to merge. A table without partitions, a dimension, is rewritten beside
    the old one and takes its place by renaming.
    """
    if not order:
        raise ValueError("an upsert needs an order that says which row is the last")
    last = last_per_key(incoming, keys, order).drop(ORIGIN)
    schema = last.schema
    if not path_exists(spark, path):
        write_partitions(last, path, partitions)
        return
    landed = shared_path(spark, "upsert-in")
    write_partitions(last, landed, partitions)
    try:
        fresh = spark.read.schema(schema).parquet(landed).select(*schema.fieldNames())
        existing = only_partitions(spark.read.schema(schema).parquet(path), fresh, partitions)
        merged = merge_upsert(existing, fresh, keys)
        if partitions:
            write_partitions(merged, path, partitions)
        else:
            replace_table(spark, merged, path)
    finally:
        remove_path(spark, landed)


def replace_table(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Write `rows`, which may be read from `path`, beside it and let them take its place.

    A failure before the renaming leaves the table as it was; one between the two
    renamings leaves both versions whole under their names.
    """
    fs, old = on_file_system(spark, path)
    beside, aside = f"{path.rstrip('/')}.new", f"{path.rstrip('/')}.old"
    for name in (beside, aside):
        remove_path(spark, name)
    write_partitions(rows, beside, [])
    for source, target in ((path, aside), (beside, path)):
        if not fs.rename(on_file_system(spark, source)[1], on_file_system(spark, target)[1]):
            raise OSError(f"{source} could not be renamed to {target}")
    remove_path(spark, aside)


def write_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()
) -> None:
    """Overwrite only the partitions present in `df`, optionally with sorted files.

    Rows are spread by partition before the write; AQE splits a partition that
    holds most rows, so a hot one is not written by a single task.
    """
    rows = df.hint("rebalance", *partitions)
    if sort:
        rows = rows.sortWithinPartitions(*partitions, *[F.asc_nulls_last(c) for c in sort])
    writer = rows.write.mode("overwrite")
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.parquet(path)


def append_partitions(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Add files to the partitions present in `df`, optionally sorted; nothing that is there is touched."""
    rows = df.hint("rebalance", *partitions)
    if sort:
        rows = rows.sortWithinPartitions(*partitions, *[F.asc_nulls_last(c) for c in sort])
    rows.write.mode("append").partitionBy(*partitions).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = on_file_system(spark, path)
    return fs.exists(p)


# -- source preference ------------------------------------------------------
def prefer(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of the first source that has a key, for every key as a whole.

    The result has the columns of the first source; one that another source lacks is
    null there. Each source's own keys meet in one small aggregate, so no source is
    read again for the next one. Null is a key like any other.
    """
    first = sources[0]

    def shaped(source: DataFrame) -> DataFrame:
        return source.select(
            *[
                F.col(f.name) if f.name in source.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in first.schema.fields
            ]
        )

    ranked = [shaped(source).withColumn("_rank", F.lit(i)) for i, source in enumerate(sources)]
    if len(ranked) == 1:
        return ranked[0].drop("_rank")
    every, own = ranked[0], ranked[0].select(*keys, "_rank").distinct()
    for rows in ranked[1:]:
        every, own = every.unionByName(rows), own.unionByName(rows.select(*keys, "_rank").distinct())
    best = own.groupBy(*keys).agg(F.min("_rank").alias("_best"))
    here, there = every.alias("here"), best.alias("there")
    same = F.col("here._rank") == F.col("there._best")
    for k in keys:
        same = same & F.col(f"here.{k}").eqNullSafe(F.col(f"there.{k}"))
    return here.join(there, same, "left_semi").select(*first.columns)


def cached_rows(
    requests: DataFrame, table: DataFrame, keys: Sequence[str], partitions: Sequence[str] = ()
) -> DataFrame:
    """Rows of a stored table for the requested keys; `partitions` are the keys it is
    partitioned by."""
    if partitions:
        table = only_partitions(table, requests, partitions)
    return table.join(requests.select(*keys).distinct(), list(keys), "left_semi")


def cache_state(requests: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored row count of each requested key, 0 where nothing is stored."""
    counts = table.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return requests.select(*keys).distinct().join(counts, list(keys), "left").select(
        *keys, F.coalesce("_rows", F.lit(0)).alias("cached_rows")
    )


# -- run ledger -------------------------------------------------------------
def ledger_entries(results: DataFrame) -> DataFrame:
    """Ledger rows for (job_name, target_date, status, message, run_id); ids grow with time."""
    return results.select(
        F.unix_micros(F.current_timestamp()).alias("id"),
        "job_name",
        "target_date",
        "status",
        "message",
        F.localtimestamp().alias("created_at"),
        "run_id",
    )


def ledger_runs(ledger: DataFrame, job_name: str) -> DataFrame:
    """(date, run_id) of a job's last run that left rows for each date."""
    closed = ledger.where((F.col("job_name") == job_name) & F.col("run_id").isNotNull())
    return closed.groupBy(F.col("target_date").alias("date")).agg(F.max_by("run_id", "id").alias("run_id"))


def append_ledger(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def ledger_latest(ledger: DataFrame) -> DataFrame:
    """Date and status of each job's last run."""
    latest = F.max_by(F.struct("target_date", "status"), F.struct("id", "target_date"))
    return ledger.groupBy("job_name").agg(F.max("id").alias("id"), latest.alias("x")).select(
        "job_name", "id", "x.target_date", "x.status"
    )


def ledger_pending_dates(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requested (job_name, target_date) whose last run is neither OK nor a skip of one that was."""
    keys = ["job_name", "target_date"]
    done = ledger.groupBy(*keys).agg(F.max_by("status", "id").alias("status"))
    return requested.join(done.where(F.col("status").isin("OK", "SKIPPED_SAME_DATE")), keys, "left_anti")


# -- checks -----------------------------------------------------------------
def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a null."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .withColumn("has_null", has_null)
        .where((F.col("rows") > 1) | F.col("has_null"))
    )


def split_by_key(df: DataFrame, keys: Sequence[str], clash: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is whole and their own, and the others with the reason.

    `clash`, an aggregate over the rows of a key, tells whether they exclude each other;
    by default more than one row does. `df` is computed once, into the shared folder.
    Keys meet as partial aggregates, and only those that clash are joined back, so a key
    that holds most rows is neither sorted nor gathered.
    """
    rows = stored(df, "keyed-rows")
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    clashes = F.count("*") > 1 if clash is None else clash
    repeated = stored(rows.where(~has_null).groupBy(*keys).agg(clashes.alias("_c")).where("_c").drop("_c"), "repeated-keys")
    good = rows.where(~has_null).join(repeated, list(keys), "left_anti").select(*df.columns)
    twice = rows.join(repeated, list(keys), "left_semi").select(*df.columns, F.lit("repeated key").alias("reason"))
    return good, rows.where(has_null).select(*df.columns, F.lit("null key").alias("reason")).unionByName(twice)


# -- column alignment -------------------------------------------------------
class MissingColumns(ValueError):
    def __init__(self, names: Sequence[str]):
        super().__init__(f"missing columns: {', '.join(names)}")
        self.names = list(names)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(missing)
    return df


def align_columns(
    df: DataFrame,
    aliases: dict[str, list[str]],
    optional: Sequence[str] = (),
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Rename to canonical names: of each list the first name present wins.

    A column that is missing takes its default, is left out if optional, or is
    reported as missing together with all others.
    """
    picked, missing = [], []
    for name, accepted in aliases.items():
        source = next((a for a in accepted if a in df.columns), None)
        if source is not None:
            picked.append(F.col(f"`{source}`").alias(name))
        elif defaults and name in defaults:
            picked.append(F.lit(defaults[name]).alias(name))
        elif name not in optional:
            missing.append(accepted[0])
    if missing:
        raise MissingColumns(missing)
    return df.select(*picked)


def link_column(df: DataFrame) -> str:
    """The first column whose name speaks of a link distance."""
    for name in df.columns:
        if all(part in name for part in S.LINK_COLUMN_PARTS):
            return name
    raise MissingColumns([S.LINK_NAMES["link_distance_m"]])


def coerce_predictions(df: DataFrame) -> DataFrame:
    """A prediction file of any accepted spelling in the canonical types.

    `df` keeps a route_no column and, where it has one, the origin; numbers that
    cannot be read become 0.
    """
    origin = [ORIGIN] if ORIGIN in df.columns else []
    aligned = align_columns(df, {"route_no": ["route_no"], **S.PREDICTION_ALIASES, **{o: [o] for o in origin}})
    metrics = ["pass_buses", "pred_board", "pred_alight", "board_per_bus", "alight_per_bus",
               "onboard_per_bus"]
    return aligned.select(
        "route_no",
        C.parse_date("date").alias("date"),
        C.whole_or_zero("hour").cast("int").alias("hour"),
        F.col("stop_id").cast("string").alias("stop_id"),
        C.whole_or_zero("stop_seq").cast("int").alias("stop_seq"),
        F.col("stop_name").cast("string").alias("stop_name"),
        *[C.number_or_zero(m).alias(m) for m in metrics],
        *origin,
    )
