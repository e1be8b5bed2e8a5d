import datetime as dt

import pytest

from stopgrid import schema as S
from stopgrid.operators import merge
from stopgrid.session import shared_path
from stopgrid.sources import files, xml


def page(service, rows, total=None, code="INFO-000"):
    body = "".join(
        "<row>" + "".join(f"<{t}>{v}</{t}>" if v is not None else f"<{t}/>" for t, v in row.items()) + "</row>"
        for row in rows
    )
    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<{service}><list_total_count>{len(rows) if total is None else total}'
        f"</list_total_count><RESULT><CODE>{code}</CODE><MESSAGE>m</MESSAGE></RESULT>{body}</{service}>"
    )


def land(folder, pages):
    folder.mkdir()
    for i, text in enumerate(pages):
        (folder / f"page_{i}.xml").write_text(text, encoding="utf-8")
    return str(folder)


def test_operations_pages(spark, tmp_path):
    row = {"CRTR_DD": "20250601", "RTE_ID": "0017", "STOPS_ID": "s1", "STOPS_SEQ": "3", "BUS_OPR": "9",
           "BUS_OPR_00": "4", "BUS_OPR_01": " 5 ", "BUS_OPR_02": "-3", "BUS_OPR_03": "3.0", "BUS_OPR_04": None}
    path = land(tmp_path / "ops", [page(S.OPS_SERVICE, [row, {**row, "STOPS_ID": "s2"}]), page(S.OPS_SERVICE, [{**row, "STOPS_SEQ": "x"}])])
    got = xml.ops_rows(xml.read_pages(spark, path, S.OPS_SERVICE)).collect()
    assert len(got) == 3 and {r["rte_id"] for r in got} == {"0017"}
    assert [got[0][f"ops_{h:02d}"] for h in range(6)] == [4, 5, 0, 0, 0, 0]
    assert sorted((r["stop_seq"] or 0) for r in got) == [0, 3, 3]


def test_monthly_first_tag_present_wins_even_if_blank(spark, tmp_path):
    row = {"USE_YM": "202506", "RTE_NO": "172", "STOPS_ID": "s", "SBWY_STNS_NM": "n", "REG_YMD": "20250703",
           "HR_0_GET_ON_TNOPE": "", "HR_0_GET_ON_NOPE": "7",
           "HR_1_GET_ON_NOPE": "8", "HR_2_GET_ON_TNOPE": "9", "HR_2_GET_ON_NOPE": "1",
           "HR_3_GET_ON_TNOPE": "x", "HR_3_GET_OFF_NOPE": "2"}
    path = land(tmp_path / "m", [page(S.MONTHLY_SERVICE, [row])])
    got = {r["hour"]: (r["board_total"], r["alight_total"]) for r in xml.monthly_rows(xml.read_pages(spark, path, S.MONTHLY_SERVICE)).collect()}
    assert len(got) == 24
    assert [got[h] for h in range(4)] == [(0, 0), (8, 0), (9, 0), (0, 2)]


def test_daily_pages_status_and_completeness(spark, tmp_path):
    def row(route, stop, board):
        return {"USE_YMD": "20250601", "RTE_ID": "r", "RTE_NO": route, "STOPS_ID": stop, "SBWY_STNS_NM": "n",
                "GTON_TNOPE": board, "GTOFF_TNOPE": "1", "REG_YMD": "bad"}
    path = land(
        tmp_path / "d",
        [
            page(S.DAILY_SERVICE, [row("1", "a", "5"), row("1", "b", "")], total=3),
            page(S.DAILY_SERVICE, [row("1", "c", "6")], total=3),
            page(S.DAILY_SERVICE, [row("2", "a", "7")], total=2),
            page(S.DAILY_SERVICE, [row("3", "a", "8")], code="ERROR-500"),
        ],
    )
    pages = xml.read_pages(spark, path, S.DAILY_SERVICE)
    got = {(r["route_no"], r["stop_id"]): r for r in xml.daily_rows(pages).collect()}
    assert {k: r["board_total"] for k, r in got.items()} == {("1", "a"): 5, ("1", "b"): 0, ("1", "c"): 6, ("2", "a"): 7}
    assert got["1", "a"]["date"] == dt.date(2025, 6, 1) and got["1", "a"]["reg_ymd"] is None
    done = {r["route_no"]: (r["landed"], r["total"], r["complete"]) for r in xml.page_completeness(pages, "USE_YMD", "RTE_NO").collect()}
    assert done == {"1": (3, 3, 1), "2": (1, 2, 0), "3": (0, 1, 0)}
    errors = xml.error_pages(pages).collect()
    assert [r["code"] for r in errors] == ["ERROR-500"] and errors[0]["file"].endswith("page_3.xml")


def test_empty_pages_are_not_complete(spark, tmp_path):
    """They belong to the route and date in their names: in the folder's or the file's."""
    for name in ("0017/20250601_1_500.xml", "N26_20250602_1_500.xml"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(page(S.DAILY_SERVICE, [], total=500), encoding="utf-8")
    pages = xml.read_pages(spark, [str(tmp_path / "0017"), str(tmp_path / "N26_20250602_1_500.xml")], S.DAILY_SERVICE)
    got = {(r["date"], r["route_no"]): (r["landed"], r["total"], r["complete"]) for r in xml.page_completeness(pages, "USE_YMD", "RTE_NO").collect()}
    assert got == {("20250601", "0017"): (0, 500, 0), ("20250602", "N26"): (0, 500, 0)}
    from stopgrid import jobs

    got = {tuple(r) for r in jobs.incomplete_input(pages, "USE_YMD", "RTE_NO").collect()}
    assert got == {(dt.date(2025, 6, 1), "0017"), (dt.date(2025, 6, 2), "N26")}


def numbered(folder, name, n, total, code="INFO-000"):
    """A page of n rows under its name."""
    rows = [{"USE_YMD": "20250601", "RTE_NO": "0017", "STOPS_ID": f"{name}-{i}"} for i in range(n)]
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    text = page(S.DAILY_SERVICE, rows, total=total, code=code)
    if total is None:
        text = text.replace(f"<list_total_count>{n}</list_total_count>", "")
    path.write_text(text, encoding="utf-8")


@pytest.mark.parametrize(
    ("landed", "gaps"),
    [
        # a doubled page does not stand for the missing one
        ([("a/20250601_1_2.xml", 2, 4), ("b/20250601_1_2.xml", 2, 4)], [(3, 4)]),
        ([("a/20250601_1_2.xml", 2, 4), ("b/20250601_1_2.xml", 2, 4), ("a/20250601_3_4.xml", 2, 4)], []),
        # the first page may go without numbers; ranges may overlap
        ([("a/20250601.xml", 3, 5), ("a/20250601_3_5.xml", 3, 5)], []),
        ([("a/20250601_4_6.xml", 3, 9)], [(1, 3), (7, 9)]),
        # a page that holds fewer rows than its name says
        ([("a/20250601_1_3.xml", 2, 5), ("a/20250601_4_5.xml", 2, 5)], [(3, 3)]),
        # a failed page, and one made good later
        ([("a/20250601_1_2.xml", 2, 4), ("a/20250601_3_4.xml", 2, 0, "ERROR-500")], [(3, 4)]),
        ([("a/20250601_1_2.xml", 2, 4), ("a/20250601_3_4.xml", 0, 0, "ERROR-500"), ("b/20250601_3_4.xml", 2, 4)], []),
        # nothing tells the total
        ([("a/20250601_1_2.xml", 2, None)], [(3, None)]),
        ([("a/20250601_1_2.xml", 2, None), ("a/20250601_3_4.xml", 2, 4)], []),
    ],
)
def test_page_gaps(spark, tmp_path, landed, gaps):
    from stopgrid import jobs

    for name, n, total, *code in landed:
        numbered(tmp_path, name, n, total, *code)
    pages = xml.read_pages(spark, [str(p) for p in tmp_path.iterdir()], S.DAILY_SERVICE)
    # routes are told by rows, and by folders where there are none
    found = xml.page_gaps(pages, "USE_YMD").collect()
    assert sorted(((r["first_missing"], r["last_missing"]) for r in found), key=str) == gaps
    assert (jobs.incomplete_input(pages, "USE_YMD").count() > 0) == bool(gaps)


def test_a_failed_page_without_a_name_cannot_be_told(spark, tmp_path):
    from stopgrid import jobs

    path = land(tmp_path / "x", [page(S.DAILY_SERVICE, [], code="ERROR-500")])
    pages = xml.read_pages(spark, path, S.DAILY_SERVICE)
    assert [tuple(r) for r in jobs.incomplete_input(pages, "USE_YMD", "RTE_NO").collect()] == [(None, None)]
    # the same page twice, without numbers, counts once
    row = {"USE_YMD": "20250601", "RTE_NO": "1", "STOPS_ID": "a"}
    twice = land(tmp_path / "y", [page(S.DAILY_SERVICE, [row], total=2)] * 2)
    done = xml.page_completeness(xml.read_pages(spark, twice, S.DAILY_SERVICE), "USE_YMD", "RTE_NO").first()
    assert (done["landed"], done["pages"], done["complete"]) == (1, 2, 0)


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_text_and_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["b,기준_날짜,시간", "0017,20250601,7", ",2025-06-02,x"])
    assert [tuple(r) for r in files.read_csv_strings(spark, path).collect()] == [("0017", "20250601", "7"), (None, "2025-06-02", "x")]
    typed = files.read_csv_typed(spark, path, {"hour": "시간", "date": "기준_날짜"}, S.struct("date date, hour int"))
    assert [tuple(r) for r in typed.collect()] == [(7, dt.date(2025, 6, 1)), (None, dt.date(2025, 6, 2))]
    with pytest.raises(merge.MissingColumns):
        files.read_csv_typed(spark, path, {"hour": "nope"}, S.struct("hour int"))


def test_stop_master_by_date_and_route(spark, tmp_path):
    path = write(
        tmp_path / "m.csv",
        ["RTE_ID,RTE_NO,STOP_ID,STOP_SEQ,링크거리,DATE", "r1,1,a,1,5.5,2025-06-01", "r1,1,b,x,5,20250601",
         "r1,1,c,3,bad,20250601", "r1,1,d,4,1,20250602", "r2,1,e,5,1,20250601"],
    )
    raw = files.read_csv_strings(spark, path)
    got = files.load_stop_master(raw, "20250601", "r1", "1").collect()
    assert {(r["stop_id"], r["stop_seq"], r["link_distance_m"]) for r in got} == {("a", 1, 5.5), ("c", 3, None)}
    # without a route id column the route number filters
    assert files.load_stop_master(raw.drop("RTE_ID"), "20250601", "r1", "1").count() == 3
    assert files.load_stop_master(raw, None, None, None).count() == 4


def test_route_map_filters_and_stamps(spark, tmp_path):
    route_map = files.load_route_map(
        files.read_csv_strings(spark, write(tmp_path / "r.csv", ["노선_ID,RTE_ID,RTE_NO", "k1, r1 ,N26", "k2,r2,0017"]))
    )
    ops = spark.createDataFrame([("k1", 1), ("k2", 2), ("k3", 3)], "route_key string, v int")
    got = {tuple(r) for r in files.filter_route_via_map(ops, route_map).select("rte_id", "route_no", "v").collect()}
    assert got == {("r1", "N26", 1), ("r2", "0017", 2)}
    wanted = spark.createDataFrame([("0017", "r2")], "route_no string, rte_id string")
    assert [r["v"] for r in files.filter_route_via_map(ops, route_map, wanted).collect()] == [2]


def test_partition_filters_prune_and_routes_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("202506", "0017", 1), ("202506", "N26", 2), ("202507", "0017", 3)], "use_ym string, route_no string, v int")
    merge.write_partitions(rows, path, ["use_ym", "route_no"])
    df = files.read_ops(spark, path, S.struct("v int, use_ym string, route_no string"), "202506", "0017")
    assert [tuple(r) for r in df.collect()] == [(1, "202506", "0017")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(use_ym" in plan and len(df.inputFiles()) == 3


def test_dated_paths():
    assert files.dated_paths("p/", ["2025-06-01", dt.date(2025, 6, 2)]) == ["p/date=2025-06-01", "p/date=2025-06-02"]
    assert files.dated_paths("p", pattern="preds_{date}.csv", today=dt.date(2025, 6, 2)) == ["p/preds_2025-06-01.csv"]


def test_upsert_statement_and_batches(spark, tmp_path):
    text = files.upsert_statement("t", ["date", "hour", "v"], ["date", "hour"])
    assert text == "INSERT INTO t (`date`, `hour`, `v`) VALUES (%s, %s, %s) ON DUPLICATE KEY UPDATE `v`=VALUES(`v`)"
    folder = str(tmp_path)

    class Recorder:
        """Stands in for a database connection; notes what is sent."""

        def __init__(self):
            self.sent = []

        def cursor(self):
            return self

        def executemany(self, statement, rows):
            self.sent.append(len(rows))

        def commit(self):
            import uuid

            with open(f"{folder}/{uuid.uuid4().hex}.txt", "w") as f:
                f.write(" ".join(map(str, self.sent)))

        def close(self):
            pass

    files.upsert_jdbc(spark.range(25).repartition(2), Recorder, text, partitions=2, batch=10)
    sent = [list(map(int, p.read_text().split())) for p in tmp_path.glob("*.txt")]
    assert sum(sum(s) for s in sent) == 25 and all(n <= 10 for s in sent for n in s)


def test_shared_path_is_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_path(spark, "x"), shared_path(spark, "x")
    assert one.startswith(base) and one != two
