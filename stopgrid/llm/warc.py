"""Sharded WARC archives, written the same way from the same rows.

Records are sorted by key into ranges whose bounds come from a sample picked by a hash
of the keys, so neither the layout of the input nor the number of executors matters.
A task writes one range at a time and rolls to the next file when the compressed size
is reached. Files get temporary names; a manifest, written by Spark and so holding the
files of each range's successful attempt alone, says which ones are renamed. Of equal
payloads the record with the smallest id is stored, the others revisit it.

Payload and header digests are computed anew by the writer from what it writes.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid.session import shared_path, stored

#: Payloads of fewer bytes are always stored.
MIN_BYTES = 100
FILE_BYTES = 32 << 20
SHARD_BYTES = 256 << 20
SAMPLE_KEYS = 20_000
#: Tasks that read or rename files at most; beyond it a task has several files.
MOST_TASKS = 20_000
DATE = "2024-01-01T00:00:00Z"
#: Fixed value: the profile of revisits with an identical payload.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "shard int, roll int, temporary string, file string, n_records long, n_bytes long, sha256 string"
MANIFEST_SCHEMA = pa.schema(
    [(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t]) for n, t in map(str.split, MANIFEST.split(", "))]
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def file_system(path: str):
    """The file system of a path or URI that all executors share, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def _payload(column: str) -> Column:
    return F.encode(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")), "UTF-8")


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = _payload(html_col)
    return pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        payload.alias("payload"),
    )


def _revisits(keyed: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, url, digest, refers_to) of the records that revisit another one."""
    able = keyed.filter(F.octet_length("payload") >= min_bytes).select("page_id", "url", "digest")
    able = stored(able, "payload-digests")
    key = F.struct(
        F.col("page_id").isNull().alias("last"), "page_id", F.coalesce("url", F.lit("")).alias("url"), F.col("url").alias("target")
    )
    first = able.groupBy("digest").agg(F.min(key).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return (
        able.join(stored(first, "first-records"), "digest")
        .filter(~(F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.coalesce("url", F.lit("")) == F.col("first.url"))))
        .select("page_id", "url", "digest", F.col("first.page_id").alias("refers_to"), F.col("first.target").alias("refers_url"))
        .distinct()
    )


def _bounds(keyed: DataFrame, n_shards: int) -> list[tuple[bool, int, int]]:
    """The smallest key of each shard but the first; keys are spread by a hash, so a hot id is dealt out too."""
    n = keyed.count()
    every = max(1, n // SAMPLE_KEYS)
    picked = keyed.filter(F.pmod(F.xxhash64("page_id", "url", "digest"), F.lit(every)) == 0)
    # rows alike in all have one key; they come as a number
    rows = picked.groupBy("page_id", F.xxhash64("url", "digest").alias("tie")).count().collect()
    keys = sorted(((id_ is not None, id_ or 0, tie), rows_) for id_, tie, rows_ in rows)
    ends = list(itertools.accumulate(rows_ for _, rows_ in keys))
    places = [bisect.bisect_right(ends, ends[-1] * i // n_shards) for i in range(1, n_shards)] if ends else []
    return sorted({keys[at][0] for at in places if at > 0})


def _shard(bounds: list) -> Column:
    """The number of bounds not above a row's key, by halving."""
    known, tie = F.col("page_id").isNotNull(), F.xxhash64("url", "digest")

    def at_least(bound) -> Column:
        has_id, id_, least = bound
        if not has_id:
            return known | (tie >= least)
        return known & ((F.col("page_id") > id_) | ((F.col("page_id") == id_) & (tie >= least)))

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at_least(bounds[middle]), among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(bounds))


def _field(text: str | None) -> str:
    """A header value without control characters, which are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "")


def _record_id(page_id, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def record_bytes(
    page_id, url, payload: bytes, refers_to=None, revisit: bool = False, date: str = DATE, refers_url: str | None = None
) -> bytes:
    """One record, not yet compressed. A revisit has the HTTP headers but no payload, and names the record it stands for."""
    digest = hashlib.sha256(payload).hexdigest()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, url, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_field(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is None:
        head.append("X-No-Target: true")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_record_id(refers_to, refers_url, digest)}"]
        head += [f"WARC-Refers-To-Target-URI: {_field(refers_url)}"] if refers_url else []
        head.append(f"X-Payload-Length: {len(payload)}")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page: {refers_to}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Rolling:
    """The files of one shard, one open at a time."""

    def __init__(self, folder: str, shard: int, file_bytes: int, level: int):
        self.files, self.root = file_system(folder)
        self.shard, self.file_bytes, self.level = shard, file_bytes, level
        self.roll, self.stream, self.done = 0, None, []
        self.files.create_dir(f"{self.root}/_temporary", recursive=True)

    def write(self, record: bytes) -> None:
        if self.stream is None:
            self.temporary = f"{self.root}/_temporary/{uuid.uuid4().hex}"
            self.stream = self.files.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.hash = 0, 0, hashlib.sha256()
        gzip = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        packed = gzip.compress(record) + gzip.flush()
        self.stream.write(packed)
        self.hash.update(packed)
        self.size += len(packed)
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> list[tuple]:
        """The manifest rows of the files so far, the open one ended."""
        if self.stream is not None:
            self.stream.close()
            name = f"{self.root}/shard-{self.shard:05d}-{self.roll:05d}.warc.gz"
            self.done.append((self.shard, self.roll, self.temporary, name, self.records, self.size, self.hash.hexdigest()))
            self.roll, self.stream = self.roll + 1, None
        return self.done


def _write_shards(folder: str, file_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: _Rolling | None = None
        noted: tuple[list, int | None, str | None] | None = None
        finished: list[tuple] = []
        for batch in batches:
            fields = ("shard", "page_id", "url", "digest", "note", "refers_to", "refers_url", "payload")
            for shard, *key, note, refers_to, refers_url, payload in zip(*(batch.column(f).to_pylist() for f in fields)):
                if out is None or out.shard != shard:
                    if out is not None:
                        finished += out.close()
                    out = _Rolling(folder, shard, file_bytes, level)
                if note:  # stands before the rows it is about
                    noted = key, refers_to, refers_url
                    continue
                revisit = noted is not None and noted[0] == key
                first = noted[1:] if revisit else (None, None)
                out.write(record_bytes(key[0], key[1], payload, first[0], revisit, date, first[1]))
        if out is not None:
            finished += out.close()
        columns = list(zip(*finished)) or [()] * len(MANIFEST_SCHEMA)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MANIFEST_SCHEMA)], schema=MANIFEST_SCHEMA)

    return run


def _rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Gives the files of the manifest their names. A second attempt finds some renamed already."""
    from pyarrow import fs

    for batch in batches:
        for temporary, name, scheme in zip(batch["temporary"], batch["file"], batch["scheme"]):
            files, _ = file_system(scheme)
            if files.get_file_info(temporary).type != fs.FileType.NotFound:
                files.move(temporary, name)
            elif files.get_file_info(name).type == fs.FileType.NotFound:
                raise FileNotFoundError(name)
        yield batch[[c.split()[0] for c in MANIFEST.split(", ")]]


def write(
    pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES,
    min_bytes: int = MIN_BYTES, level: int = 6, date: str = DATE,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Writes one record per row of `pages` under `folder` and returns the manifest.

    `folder` must be new and reachable from all executors. A null payload is empty, a
    null id has no header and sorts first, a null address is marked. Of equal payloads of at least
    `min_bytes` the one with the smallest (id, address) is a response, ids before null, and rows equal to it in
    both are responses too; all others revisit it. Other columns are ignored, and an
    empty table writes no file and an empty manifest.
    """
    spark = pages.sparkSession
    keyed = _keyed(pages, id_col, url_col, html_col)
    size = keyed.agg(F.sum(F.octet_length("payload").cast("long") + 500)).first()[0] or 0
    shards = int(max(size // shard_bytes + 1, min(spark.sparkContext.defaultParallelism, size // (4 << 20) + 1)))
    bounds = _bounds(keyed, shards)
    shard = _shard(bounds)
    notes = _revisits(keyed, min_bytes)
    records = (
        notes.select("*", F.lit(None).cast("binary").alias("payload"), F.lit(True).alias("note"))
        .unionByName(
            keyed.withColumns(
                {"refers_to": F.lit(None).cast("long"), "refers_url": F.lit(None).cast("string"), "note": F.lit(False)}
            )
        )
        .withColumn("shard", shard)
        .repartitionById(len(bounds) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "page_id", "url", "digest", F.col("note").desc())
    )
    written = records.mapInArrow(_write_shards(folder, file_bytes, level, date), MANIFEST)
    manifest = stored(written, "manifest")
    named = _by_file(manifest.withColumn("scheme", F.lit(folder))).mapInPandas(_rename, MANIFEST)
    named.write.parquet(f"{folder.rstrip('/')}/_manifest")
    files, root = file_system(folder)
    if size:
        files.delete_dir(f"{root}/_temporary")  # what lost attempts left
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/_manifest")


def _by_file(manifest: DataFrame) -> DataFrame:
    """The manifest with about a file for each task, however small its rows are."""
    return manifest.repartition(min(max(manifest.count(), 1), MOST_TASKS), "file")


def _members(stream, at_once: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one record each."""
    gzip, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(at_once)
        rest = b""
        if not data:
            return
        parts.append(gzip.decompress(data))
        if gzip.eof:
            yield b"".join(parts)
            rest, gzip, parts = gzip.unused_data, zlib.decompressobj(31), []


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises if the block is not what its digest says."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block


RECORD_SCHEMA = pa.schema(
    [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in map(str.split, RECORD.split(", "))]
)


def _read_files(with_payload: bool):
    def out(rows: list[tuple]) -> pa.RecordBatch:
        # column by column, so that an id beside a null stays an integer
        columns = list(zip(*rows)) or [()] * len(RECORD_SCHEMA)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RECORD_SCHEMA)], schema=RECORD_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, scheme in zip(*(batch.column(c).to_pylist() for c in ("file", "scheme"))):
                files, _ = file_system(scheme)
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for raw in _members(stream):
                        fields, block = parse_record(raw)
                        payload = block.partition(b"\r\n\r\n")[2]
                        response = fields["WARC-Type"] == "response"
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if response and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
                        rows.append(
                            (
                                int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
                                None if "X-No-Target" in fields else fields["WARC-Target-URI"],
                                fields["WARC-Type"],
                                int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None,
                                len(payload) if response else int(fields["X-Payload-Length"]),
                                digest,
                                payload if with_payload and response else None,
                            )
                        )
                        held += len(raw)
                        if held > 16 << 20:
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)

    return run


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the manifest of `folder`, a file at a time; digests are checked.

    payload_bytes and payload_digest are those of the full payload for revisits too;
    the payload itself is null for them.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/_manifest")
    files = _by_file(manifest.select("file", F.lit(folder).alias("scheme")))
    return files.mapInArrow(_read_files(with_payload), RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return shared_path(spark, "warc")
