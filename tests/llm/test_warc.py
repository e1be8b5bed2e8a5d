"""Archives written and read again, and what their files hold."""

import gzip
import hashlib

import pytest

from stopgrid.llm import warc

BIG = "<p>" + "equal payload " * 20 + "</p>"
ROWS = [
    (5, "http://b/", BIG),
    (3, "http://a/", BIG),
    (3, "http://c/", BIG),
    (9, None, BIG),
    (None, "http://n/", BIG),
    (7, "http://short/", "tiny"),
    (8, "http://short/", "tiny"),
    (1, "http://null/", None),
    (2, "http://empty/", ""),
    (4, "http://sp ace/\r\nX: y", "é" * 60),
    (6, "http://long/", "x" * 3_000_000),
    (6, "http://long/", "x" * 3_000_000),
    (10, "http://long/2", "x" * 3_000_000),
    ((1 << 53) + 1, "http://large/", "other " * 50),
    ((1 << 53) + 3, "http://large/2", "other " * 50),
    ((1 << 53) + 5, None, "other " * 50),
    ((1 << 53) + 7, "http://tiny/", "t"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string")


def expected():
    out = []
    for page_id, url, html in ROWS:
        payload = (html or "").encode()
        same = [(i is None, i or 0, u or "") for i, u, h in ROWS if (h or "").encode() == payload]
        first = min(same)
        revisit = len(payload) >= 100 and (page_id is None, page_id or 0, url or "") != first
        kind = "revisit" if revisit else "response"
        out.append((page_id, kind, first[1] if revisit else None, len(payload), hashlib.sha256(payload).hexdigest()))
    return sorted(out, key=str)


def records(df):
    names = ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def bytes_of(folder):
    return {p.name: p.read_bytes() for p in folder.glob("*.warc.gz")}


def test_round_trip(spark, pages, tmp_path):
    manifest = warc.write(pages, str(tmp_path / "out"), file_bytes=400, shard_bytes=1000)
    found = warc.read(spark, str(tmp_path / "out"))
    assert records(found) == expected()
    payloads = {r["page_id"]: r["payload"] for r in found.collect() if r["record_type"] == "response"}
    assert bytes(payloads[4]) == ("é" * 60).encode() and bytes(payloads[1]) == b""
    files = manifest.collect()
    assert sum(f["n_records"] for f in files) == len(ROWS) and len(files) > 3
    written = bytes_of(tmp_path / "out")
    assert {f["file"].rsplit("/", 1)[1]: (f["n_bytes"], f["sha256"]) for f in files} == {
        n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in written.items()
    }
    assert not (tmp_path / "out/_temporary").exists()


def test_same_rows_same_files(pages, tmp_path):
    for name, parts in (("a", 1), ("b", 5)):
        warc.write(pages.repartition(parts, "html"), str(tmp_path / name), file_bytes=600, shard_bytes=2000)
    assert bytes_of(tmp_path / "a") == bytes_of(tmp_path / "b")


def test_files_are_plain_warc(pages, tmp_path):
    warc.write(pages, str(tmp_path / "out"))
    for name, data in bytes_of(tmp_path / "out").items():
        raw = gzip.decompress(data)
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            block, raw = rest[:n], rest[n:]
            assert raw[:4] == b"\r\n\r\n" and b"\r\n" not in fields[b"WARC-Target-URI"]
            assert fields[b"WARC-Block-Digest"].decode() == "sha256:" + hashlib.sha256(block).hexdigest()
            raw = raw[4:]


def test_revisits_name_the_record_they_stand_for(pages, tmp_path):
    warc.write(pages, str(tmp_path / "out"), file_bytes=500, shard_bytes=1500)
    ids, refers = {}, []
    for data in bytes_of(tmp_path / "out").values():
        for raw in warc._members(__import__("io").BytesIO(data)):
            fields, _ = warc.parse_record(raw)
            if fields["WARC-Type"] == "response":
                ids[fields["WARC-Record-ID"]] = fields
            else:
                refers.append(fields)
    assert len(refers) == sum(kind == "revisit" for _, kind, *_ in expected())
    for fields in refers:
        first = ids[fields["WARC-Refers-To"]]
        assert first["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
        assert first["X-Page-Id"] == fields["X-Refers-To-Page"]


def test_a_task_for_each_shard_and_file(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(sha2(cast(id as string), 512), 8) as html")
    keyed = warc._keyed(rows, "page_id", "url", "html")
    dealt = keyed.withColumn("shard", warc._shard(warc._bounds(keyed, 16))).repartitionById(16, "shard")
    sizes = [len(part) for part in dealt.rdd.glom().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)
    manifest = warc.write(rows, str(tmp_path / "out"), file_bytes=50_000, shard_bytes=400_000)
    assert warc._by_file(manifest).rdd.getNumPartitions() == manifest.count() > 8


def test_a_hot_row_comes_to_the_driver_as_a_number(spark):
    rows = spark.range(3000).selectExpr("if(id < 2000, 1, id) as page_id", "'u' as url", "'h' as html")
    bounds = warc._bounds(warc._keyed(rows, "page_id", "url", "html"), 4)
    assert 1 <= len(bounds) <= 3 and len(set(bounds)) == len(bounds)


def test_damage_is_noticed(pages, tmp_path, spark):
    with pytest.raises(ValueError, match="damaged record"):
        record = warc.record_bytes(1, "u", b"some payload")
        warc.parse_record(record.replace(b"some", b"same"))
    with pytest.raises(ValueError, match="no WARC"):
        warc.parse_record(b"else\r\n\r\n")


def test_renaming_again_changes_nothing(pages, tmp_path):
    import pandas as pd

    manifest = warc.write(pages, str(tmp_path / "out")).toPandas()
    before = bytes_of(tmp_path / "out")
    manifest["scheme"] = str(tmp_path / "out")
    list(warc._rename([manifest]))
    assert bytes_of(tmp_path / "out") == before
    gone = pd.DataFrame([{**manifest.iloc[0], "file": str(tmp_path / "out/none")}])
    with pytest.raises(FileNotFoundError):
        list(warc._rename([gone]))


def test_empty_table_and_clashing_columns(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write(none, str(tmp_path / "none")).count() == 0
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
    more = spark.createDataFrame([(1, "u", "h", "d", 2, True)], "page_id long, url string, html string, digest string, shard int, note boolean")
    warc.write(more, str(tmp_path / "more"))
    assert records(warc.read(spark, str(tmp_path / "more"))) == [(1, "response", None, 1, hashlib.sha256(b"h").hexdigest())]
