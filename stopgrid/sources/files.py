"""Parquet, CSV and JDBC: readers and writers."""

from __future__ import annotations

import csv
import datetime as dt
import functools
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopgrid import schema as S
from stopgrid.functions import columns as C
from stopgrid.operators.merge import ORIGIN, align_columns, link_column, require_columns, with_origin


# -- CSV --------------------------------------------------------------------
def read_csv_strings(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """Every column as text; names come from the header line."""
    return spark.read.options(**{"header": "true", "encoding": "UTF-8", **options}).csv(path)


def read_csv_typed(
    spark: SparkSession, path: str | Sequence[str], names: dict[str, str], schema: T.StructType
) -> DataFrame:
    """Columns by header name in the types of `schema`; bad values become null.

    `names` maps canonical to file names. Only the named columns are parsed.
    """
    raw = require_columns(read_csv_strings(spark, path), list(names.values()))

    def typed(name: str, source: str) -> Column:
        kind = schema[name].dataType
        text = F.col(f"`{source}`")
        return C.parse_date(text) if isinstance(kind, T.DateType) else text.try_cast(kind)

    return raw.select(*[typed(n, s).alias(n) for n, s in names.items()])


def write_csv(df: DataFrame, path: str, partitions: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Header CSV in one folder per partition value; only those folders are replaced."""
    rows = df.hint("rebalance", *partitions) if partitions else df
    writer = rows.write.mode(mode).option("header", "true").option("encoding", "UTF-8")
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


# -- operations table in Parquet --------------------------------------------
def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned table with the declared types: route '0017' stays text."""
    return spark.read.schema(schema).parquet(path)


def read_ops(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    use_ym: str | None = None,
    route_no: str | None = None,
) -> DataFrame:
    """Month and route filters on partition columns prune folders, not rows."""
    df = read_partitioned(spark, path, schema)
    if use_ym is not None:
        df = df.where(F.col("use_ym") == use_ym)
    if route_no is not None:
        df = df.where(F.col("route_no") == route_no)
    return df


def bronze(raw: DataFrame, use_ym: str | None = None, route_no: str | None = None,
           date: str | None = None) -> DataFrame:
    """Wide operations CSV with trimmed keys, a month and a compact date."""
    hours = [c for c in raw.columns if c.startswith(S.HOUR_TAG_PREFIX)]
    names = S.OPS_WIDE_NAMES
    text = F.trim(F.col(f"`{names['date']}`"))
    rows = raw.select(
        C.use_ym(text).alias("use_ym"),
        F.regexp_replace(text, "-", "").alias("date"),
        *[F.trim(F.col(f"`{names[n]}`")).alias(n) for n in ("route_key", "stop_id", "route_no")],
        F.col(f"`{names['stop_seq']}`").try_cast("int").alias("stop_seq"),
        *[F.col(f"`{h}`") for h in hours],
    )
    for name, value in (("use_ym", use_ym), ("route_no", route_no), ("date", date)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows


# -- dimension files --------------------------------------------------------
def load_route_map(raw: DataFrame) -> DataFrame:
    require_columns(raw, list(S.ROUTE_MAP_NAMES.values()))
    return raw.select(
        *[F.trim(F.col(f"`{s}`").cast("string")).alias(n) for n, s in S.ROUTE_MAP_NAMES.items()], *_origin(raw)
    )


def _origin(raw: DataFrame) -> list[str]:
    return [ORIGIN] if ORIGIN in raw.columns else []


def load_link_distance(raw: DataFrame) -> DataFrame:
    require_columns(raw, list(S.LINK_NAMES.values()))
    name = {n: F.col(f"`{s}`") for n, s in S.LINK_NAMES.items()}
    return raw.select(
        name["route_key"].cast("string").alias("route_key"),
        name["stop_id"].cast("string").alias("stop_id"),
        C.to_number(name["stop_seq"]).try_cast("int").alias("stop_seq"),
        C.to_number(name["link_distance_m"]).alias("link_distance_m"),
        *_origin(raw),
    )


def load_sequence_links(raw: DataFrame, route_no: str | None = None) -> DataFrame:
    """Link distances by sequence, from the first column that names them.

    The route comes from the file's route number column, else from the argument.
    """
    route, seq = S.OPS_WIDE_NAMES["route_no"], S.LINK_NAMES["stop_seq"]
    require_columns(raw, [seq] if route_no is not None else [seq, route])
    return raw.select(
        (F.lit(route_no) if route_no is not None else F.trim(F.col(f"`{route}`"))).alias("route_no"),
        C.to_number(F.col(f"`{seq}`")).try_cast("int").alias("stop_seq"),
        C.to_number(F.col(f"`{link_column(raw)}`")).alias("link_distance_m"),
    )


def load_stop_master(
    raw: DataFrame, date: str | None = None, rte_id: str | None = None, route_no: str | None = None
) -> DataFrame:
    """Stop master in any accepted spelling.

    The date filter compares digits only; the route filter uses the route id where
    the file has one, else the route number. Rows without stop id or sequence are
    dropped. Without a date all dates are kept.
    """
    optional = ["route_key", "rte_id", "route_no", "link_distance_m", "date"]
    rows = align_columns(raw, {**S.STOP_MASTER_ALIASES, **{o: [o] for o in _origin(raw)}}, optional=optional)
    if "date" in rows.columns:
        rows = rows.withColumn("date", C.digits_only("date"))
        if date is not None:
            rows = rows.where(F.col("date") == date)
    if "rte_id" in rows.columns:
        if rte_id is not None:
            rows = rows.where(F.col("rte_id") == rte_id)
    elif "route_no" in rows.columns and route_no is not None:
        rows = rows.where(F.col("route_no") == route_no)
    for name in ("route_key", "link_distance_m", "date"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows.select(
        "date",
        "route_key",
        "stop_id",
        C.to_number("stop_seq").try_cast("int").alias("stop_seq"),
        C.to_number("link_distance_m").alias("link_distance_m"),
        *_origin(rows),
    ).dropna(subset=["stop_id", "stop_seq"])


def filter_route_via_map(ops: DataFrame, route_map: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Operations rows with the route id and number their route key maps to.

    `routes` (route_no, rte_id) restricts the map; rows without a mapping drop out. Of
    several map rows of a key the smallest (route id, route number) is taken.
    """
    wanted = route_map if routes is None else route_map.join(routes, ["route_no", "rte_id"], "left_semi")
    one = wanted.groupBy("route_key").agg(F.min(F.struct("rte_id", "route_no")).alias("_m"))
    return ops.drop("route_no", "rte_id").join(one.select("route_key", "_m.*"), "route_key")


# -- dated prediction files -------------------------------------------------
def dated_paths(
    prefix: str,
    dates: Iterable[dt.date | str] | None = None,
    pattern: str = "date={date}",
    offset_days: int = S.DATE_OFFSET_DAYS,
    today: dt.date | None = None,
) -> list[str]:
    """One path per date; without dates the day `offset_days` before today (UTC)."""
    if dates is None:
        today = today or dt.datetime.now(dt.timezone.utc).date()
        dates = [today - dt.timedelta(days=offset_days)]
    return [f"{prefix.rstrip('/')}/{pattern.format(date=d)}" for d in dates]


def header_catalogue(spark: SparkSession, paths: str | Sequence[str], base: str | None = None) -> DataFrame:
    """(file, header): the first line of every file under the paths, without a byte order mark.

    One job for all files: each task passes on one line a file, that of the smallest place.
    """
    lines = spark.read.options(**({"basePath": base} if base else {})).text(list(paths) if not isinstance(paths, str) else paths)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    ).where("block = 0")
    first = placed.groupBy("file").agg(F.min_by("value", "row").alias("header"))
    return first.select("file", F.regexp_replace(F.rtrim("header"), "^\ufeff", "").alias("header"))


def read_predictions(spark: SparkSession, paths: str | Sequence[str], base: str | None = None) -> DataFrame:
    """All given files as text, with their origin; every file's columns by its own header.

    Files with the same header are one scan, and the headers of all files are read in one
    job before. A column that only some have is null in the others; empty files have no
    part.
    """
    alike: dict[str, list[str]] = defaultdict(list)
    for file, header in header_catalogue(spark, paths, base).collect():
        alike[header].append(file)
    if not alike:
        raise ValueError(f"no files with a header in {paths}")
    scans = []
    for header, same in sorted(alike.items()):
        names = header_names(header)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        options = {"header": "true", "encoding": "UTF-8", "enforceSchema": "true", **({"basePath": base} if base else {})}
        scans.append(with_origin(spark.read.options(**options).schema(schema).csv(sorted(same))))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def header_names(header: str) -> list[str]:
    """The column names of a header line, as the reader of CSV files splits it; repeated names get their place."""
    (names,) = csv.reader([header])
    return [f"{n}{i}" if n and names.count(n) > 1 else n or f"_c{i}" for i, n in enumerate(names)]


# -- files of a landing folder ----------------------------------------------
def listed_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, modified) of the files below a folder, by their listing; no content is read."""
    found = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup="true").load(path)
    return found.select("path", F.col("modificationTime").alias("modified"))


def unseen_files(spark: SparkSession, path: str, pattern: str, ledger: DataFrame | None) -> DataFrame:
    """Listed files that the ledger does not hold as they are now: new ones and such as were replaced."""
    found = listed_files(spark, path, pattern)
    return found if ledger is None else found.join(ledger.select("path", "modified"), ["path", "modified"], "left_anti")


# -- JDBC -------------------------------------------------------------------
def read_jdbc(spark: SparkSession, url: str, table: str, predicates: list[str] | None = None,
              **properties: str) -> DataFrame:
    """A database table; `predicates` splits the read into one task each."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, partitions: int = 16, batch: int = 5000,
               mode: str = "append", **properties: str) -> None:
    """Append with a bounded number of connections."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, numPartitions=str(partitions), batchsize=str(batch), **properties)
        .mode(mode)
        .save()
    )


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], placeholder: str = "%s") -> str:
    """INSERT that overwrites all other columns of a row whose key exists."""
    names = ", ".join(f"`{c}`" for c in columns)
    marks = ", ".join([placeholder] * len(columns))
    updates = ", ".join(f"`{c}`=VALUES(`{c}`)" for c in columns if c not in keys)
    return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {updates}"


def upsert_jdbc(
    df: DataFrame, connect: Callable[[], object], statement: str, partitions: int = 16, batch: int = 5000
) -> None:
    """Run an upsert statement for every row, in batches, one connection per task.

    The statement is idempotent per key, so a task that runs twice does no harm.
    """

    def send(rows: Iterable[T.Row]) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            pending: list[tuple] = []
            for row in rows:
                pending.append(tuple(row))
                if len(pending) == batch:
                    cursor.executemany(statement, pending)
                    pending = []
            if pending:
                cursor.executemany(statement, pending)
            connection.commit()
        finally:
            connection.close()

    df.repartition(partitions).foreachPartition(send)
