import datetime as dt

import pytest
from pyspark.sql import functions as F

from stopgrid import schema as S
from stopgrid.operators import merge
from stopgrid.streaming.incremental import ingest_available

D = [dt.date(2024, 3, d) for d in range(1, 8)]
SCHEMA = S.struct("route_no string, date date, hour int, v bigint")
KEYS = ["route_no", "date", "hour"]


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def content(df):
    return sorted((r["route_no"], r["date"], r["hour"], r["v"]) for r in df.collect())


def test_upsert_replaces_extends_and_repeats_safely(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, [("0017", D[0], 1, 10), ("0017", D[0], 2, 20), ("0017", D[1], 1, 30)])
    second = rows(spark, [("0017", D[0], 2, 21), ("0017", D[2], 1, 40)])
    merge.upsert_table(spark, path, first, KEYS, ["route_no", "date"], ["v"])
    untouched = [p.stat().st_mtime_ns for p in tmp_path.glob(f"t/route_no=0017/date={D[1]}/*.parquet")]
    for _ in range(2):
        merge.upsert_table(spark, path, second, KEYS, ["route_no", "date"], ["v"])
        got = content(spark.read.schema(SCHEMA).parquet(path))
        assert got == [("0017", D[0], 1, 10), ("0017", D[0], 2, 21), ("0017", D[1], 1, 30), ("0017", D[2], 1, 40)]
    assert untouched == [p.stat().st_mtime_ns for p in tmp_path.glob(f"t/route_no=0017/date={D[1]}/*.parquet")]


def test_later_row_of_a_key_wins(spark):
    base = rows(spark, [("7", D[0], 1, 1)])
    new = rows(spark, [("7", D[0], 1, 5), ("7", D[0], 1, 9), ("7", D[0], 2, 3)])
    assert content(merge.merge_upsert(base, new, KEYS, ["v"])) == [("7", D[0], 1, 9), ("7", D[0], 2, 3)]


def test_null_keys_are_never_replaced_but_reported(spark):
    base = rows(spark, [("7", D[0], None, 1)])
    both = merge.merge_upsert(base, rows(spark, [("7", D[0], None, 2)]), KEYS)
    assert both.count() == 2
    found = merge.key_violations(both.unionByName(rows(spark, [("7", D[0], 3, 1), ("7", D[0], 3, 1)])), KEYS).collect()
    assert {(r["hour"], r["rows"], r["has_null"]) for r in found} == {(None, 2, True), (3, 2, False)}


def test_partitions_between_the_touched_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_table(spark, path, rows(spark, [("7", d, 1, 1) for d in D]), KEYS, ["date"], ["v"])
    merge.upsert_table(spark, path, rows(spark, [("7", d, 1, 2) for d in (D[0], D[2], D[3])]), KEYS, ["date"], ["v"])
    assert [v for *_, v in content(spark.read.schema(SCHEMA).parquet(path))] == [2, 1, 2, 2, 1, 1, 1]


def test_the_last_file_wins(spark, tmp_path):
    """Six versions of the same keys, landed one after the other, in one batch and in one stream run."""
    land, path, table, mark = (str(tmp_path / n) for n in ("land", "t", "s", "mark"))
    for v in range(6):
        rows(spark, [("7", d, 1, v) for d in D]).coalesce(1).write.mode("append").parquet(land)
    landed = merge.with_origin(spark.read.schema(SCHEMA).parquet(land))
    for _ in range(2):
        merge.upsert_table(spark, path, landed, KEYS, ["date"], [merge.ORIGIN])
        stored = spark.read.parquet(path)
        assert merge.ORIGIN not in stored.columns and {r["v"] for r in stored.collect()} == {5}
    ingest_available(spark, land, table, mark, SCHEMA, KEYS, ["date"])
    assert {r["v"] for r in spark.read.parquet(table).collect()} == {5}
    with pytest.raises(ValueError, match="order"):
        merge.upsert_table(spark, path, landed, KEYS, ["date"], [])


def test_later_rows_of_a_file_win(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("k,v\n" + "".join(f"{i % 3},{i}\n" for i in range(30)))
    scan = merge.with_origin(spark.read.csv(str(path), header=True))
    assert sorted(r["v"] for r in merge.last_per_key(scan, ["k"], [merge.ORIGIN]).collect()) == ["27", "28", "29"]


def test_tables_without_partitions_are_swapped(spark, tmp_path):
    path = str(tmp_path / "dim")
    schema = "k string, v int"
    merge.upsert_table(spark, path, spark.createDataFrame([("a", 1), ("b", 1)], schema), ["k"], [], ["v"])
    merge.upsert_table(spark, path, spark.createDataFrame([("b", 2), ("c", 2)], schema), ["k"], [], ["v"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["dim"]


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.write_partitions(rows(spark, [("0017", D[0], 1, 1), ("N26", D[1], 1, 2)]), path, ["route_no", "date"])
    merge.write_partitions(rows(spark, [("N26", D[1], 5, 3)]), path, ["route_no", "date"], ["hour"])
    got = content(spark.read.schema(SCHEMA).parquet(path))
    assert got == [("0017", D[0], 1, 1), ("N26", D[1], 5, 3)]


def ledger(spark, entries):
    return spark.createDataFrame(
        [(i, "job", d, s, None, None, None) for i, d, s in entries], S.RUN_LEDGER
    )


def test_only_a_successful_last_run_is_skipped(spark):
    book = ledger(spark, [(1, D[0], "NO_DATA"), (2, D[0], "OK"), (3, D[1], "OK"), (4, D[1], "ERROR"), (5, D[2], "NO_DATA")])
    skipped = ledger(spark, [(1, D[0], "OK"), (2, D[0], "SKIPPED_SAME_DATE")])
    asked = spark.createDataFrame([("job", d) for d in D[:4]], "job_name string, target_date date")
    assert sorted(r["target_date"] for r in merge.ledger_pending_dates(asked, skipped).collect()) == D[1:4]
    assert sorted(r["target_date"] for r in merge.ledger_pending_dates(asked, book).collect()) == D[1:4]
    last = merge.ledger_latest(book).first()
    assert (last["id"], last["target_date"], last["status"]) == (5, D[2], "NO_DATA")


def test_source_preference_takes_whole_keys(spark):
    a = rows(spark, [("7", D[0], 1, 100)])
    b = rows(spark, [("7", D[0], 1, 1), ("7", D[0], 2, 2), ("7", D[1], 1, 3)])
    assert content(merge.prefer([a, b], ["route_no", "date"])) == [("7", D[0], 1, 100), ("7", D[1], 1, 3)]
    none = b.withColumn("route_no", F.lit(None).cast("string"))
    assert content(merge.prefer([a, none.drop("v")], ["route_no"]).where("route_no is null").na.fill("-", ["route_no"])) == [
        ("-", D[0], 1, None), ("-", D[0], 2, None), ("-", D[1], 1, None)
    ]


def test_cache_state(spark):
    asked = spark.createDataFrame([("7", D[0]), ("7", D[1])], "route_no string, date date")
    table = rows(spark, [("7", D[0], 1, 1), ("7", D[0], 2, 1), ("8", D[1], 1, 1)])
    got = {r["date"]: r["cached_rows"] for r in merge.cache_state(asked, table, ["route_no", "date"]).collect()}
    assert got == {D[0]: 2, D[1]: 0}
    assert merge.cached_rows(asked, table, ["route_no", "date"], ["date"]).count() == 2


def test_alignment_reports_all_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "hour int, HOUR2 int")
    with pytest.raises(merge.MissingColumns) as error:
        merge.align_columns(df, {"date": ["기준_날짜"], "hour": ["시간", "hour"], "x": ["X"]}, defaults={})
    assert error.value.names == ["기준_날짜", "X"]


def test_first_accepted_name_wins(spark):
    df = spark.createDataFrame([(1, 2)], "hour int, `시간` int")
    assert merge.align_columns(df, {"hour": ["시간", "hour"]}).first()["hour"] == 2


def test_link_column(spark):
    df = spark.createDataFrame([(1, 2.0)], "x int, `링크_구간거리(m)` double")
    assert merge.link_column(df) == "링크_구간거리(m)"
    with pytest.raises(merge.MissingColumns):
        merge.link_column(df.select("x"))


def test_stream_upserts_new_files_only(spark, tmp_path):
    land, table, mark = (str(tmp_path / n) for n in ("land", "table", "mark"))
    run = lambda: ingest_available(spark, land, table, mark, SCHEMA, KEYS, ["date"], files_per_batch=1)
    rows(spark, [("7", D[0], 1, 1), ("7", D[1], 1, 1)]).coalesce(1).write.mode("append").parquet(land)
    run()
    run()  # nothing new
    rows(spark, [("7", D[1], 1, 5), ("7", D[2], 1, 2)]).coalesce(1).write.mode("append").parquet(land)
    run()
    got = content(spark.read.schema(SCHEMA).parquet(table))
    assert got == [("7", D[0], 1, 1), ("7", D[1], 1, 5), ("7", D[2], 1, 2)]


def test_rebalance_hint_reaches_the_plan(spark):
    df = rows(spark, [("7", D[0], 1, 1)]).hint("rebalance", "date")
    assert "REBALANCE" in df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_are_removed(spark):
    from stopgrid import session

    with session.releasing(spark):
        known = session.stored(spark.range(3), "means")
        path = session._stored[-1]
        assert known.count() == 3 and merge.path_exists(spark, path)
    assert not merge.path_exists(spark, path)


def test_split_by_key(spark):
    from stopgrid.operators import demand

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    good, bad = merge.split_by_key(rows, ["k"])
    assert [tuple(r) for r in good.collect()] == [("b", 1)]
    assert sorted(tuple(r) for r in bad.fillna("-").collect()) == [("-", 1, "null key")] * 2 + [("a", 1, "repeated key"), ("a", 2, "repeated key")]
    # two visits of a stop may share its hours, but not give one twice
    days = spark.createDataFrame(
        [("s", [(5, 1)]), ("s", [(6, 2)]), ("t", [(5, 1), (23, 1)]), ("t", [(23, 4)])], "k string, hours array<struct<hour: int, ops: bigint>>"
    )
    good, bad = merge.split_by_key(days, ["k"], demand.hours_clash())
    assert {r["k"] for r in good.collect()} == {"s"} and {r["k"] for r in bad.collect()} == {"t"}
    none, no = merge.split_by_key(rows.limit(0), ["k"])
    assert none.count() == no.count() == 0
