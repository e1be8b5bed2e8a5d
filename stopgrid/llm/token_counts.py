"""Token counts of byte-level BPE without token ids.

A text is cut into pre-tokens, and a pre-token always gives the same pieces. So each
distinct pre-token is counted once, the counts are joined to the pre-token
frequencies of the documents, and a document's products are summed.

The join is one of packed rows. A chunk is a bounded run of documents; its frequencies
are dealt by a hash of the pre-token into buckets, and a row holds what a chunk has in
a bucket: the pre-tokens and, for each, the documents' places in the chunk with their
frequencies. Rows meet by bucket, where each pre-token is counted when first seen.
However frequent a pre-token is, it comes once per chunk, so no bucket grows hot. The
sums travel back by chunk, next to the ids of its documents.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopgrid.llm.common import small_batches, text_of

#: Fixed value: how byte-level BPE splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the same for the characters below.
COMMON_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+"
#: Characters whose classes are the same in all libraries.
COMMON = re.compile(r"[\t\n\r\x20-\x7eÀ-ÿ]*")
#: Where a text may be cut without changing its pre-tokens.
CUT = re.compile(r"(?<=\S) (?=\S)")

CHUNK_CHARS = 16_000_000
CHUNK_DOCS = 65_535  # places are kept in two bytes
SLICE_CHARS = 1_000_000
#: Buckets at least, and bytes of text for each beyond them.
BUCKETS = 1024
BUCKET_BYTES = 1 << 30
SUMS_AT_ONCE = 4_000_000


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Splitter:
    def __init__(self, path: str):
        self.library = _tokenizer(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        longest_first = sorted(added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.added = set(added)
        self.find = re.compile(COMMON_PATTERN).findall
        self.find_any = regex.compile(PATTERN).findall

    def __call__(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, a bounded slice at a time; an added token's string is one of them."""
        if self.special is None or not any(t in text for t in self.added):
            yield from map(self.plain, _slices(text))
            return
        for part in self.special.split(text):
            if part in self.added:
                yield [part]
            else:
                yield from map(self.plain, _slices(part))

    def plain(self, text: str) -> list[str]:
        if COMMON.fullmatch(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)] if text else []


def _slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SLICE_CHARS and (cut := CUT.search(text, at + SLICE_CHARS)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _row_schema(id_type: pa.DataType) -> pa.Schema:
    """A chunk's share of a bucket; without tokens, a chunk's documents."""
    return pa.schema(
        [
            ("chunk", pa.int64()), ("bucket", pa.int32()), ("tokens", pa.string()), ("lengths", pa.binary()),
            ("spread", pa.binary()), ("docs", pa.binary()), ("freqs", pa.binary()),
            ("ids", pa.list_(id_type)), ("sizes", pa.list_(pa.int64())),
        ]
    )


class _Chunk:
    def __init__(self, number: int, buckets: int):
        self.number, self.buckets = number, buckets
        self.ids, self.sizes, self.chars = [], [], 0
        self.place_of: dict[str, int] = defaultdict()
        self.place_of.default_factory = self.place_of.__len__
        self.seen: list[np.ndarray] = []
        self.owners: list[int] = []

    def add(self, id_, text: str, parts: Iterator[list[str]]) -> None:
        for tokens in parts:
            self.seen.append(np.fromiter(map(self.place_of.__getitem__, tokens), np.uint32, len(tokens)))
            self.owners.append(len(self.ids))
        self.ids.append(id_)
        self.sizes.append(len(text.encode("utf-8", "surrogatepass")))
        self.chars += len(text)

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        tokens = list(self.place_of)
        bucket = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in tokens), np.uint32, len(tokens)) % self.buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(tokens), np.uint64)
        rank[order] = np.arange(len(tokens), dtype=np.uint64)
        owner = np.repeat(np.array(self.owners, np.uint64), [len(s) for s in self.seen])
        places = np.concatenate(self.seen) if self.seen else np.zeros(0, np.uint32)
        pairs, freqs = np.unique(rank[places] << np.uint64(16) | owner, return_counts=True)
        # a frequency takes one byte; a larger one is said in several
        times = (freqs + 254) // 255
        pairs, last = np.repeat(pairs, times), np.cumsum(times) - 1
        said = np.full(len(pairs), 255, np.uint8)
        said[last] = freqs - 255 * (times - 1)
        which = (pairs >> np.uint64(16)).astype(np.int64)
        docs = (pairs & np.uint64(0xFFFF)).astype("<u2")
        spread = np.bincount(which, minlength=len(tokens)).astype("<u4")
        used, begin = np.unique(bucket[order], return_index=True)
        ends = np.append(begin[1:], len(tokens))
        edge = np.concatenate([[0], np.cumsum(spread.astype(np.int64))])
        names = [tokens[i] for i in order.tolist()]
        lengths = np.fromiter(map(len, names), "<u4", len(names))
        cells = [(self.number, self.number % self.buckets, None, None, None, None, None, self.ids, self.sizes)]
        for b, i, j in zip(used.tolist(), begin.tolist(), ends.tolist()):
            a, z = edge[i], edge[j]
            part = ("".join(names[i:j]), lengths[i:j].tobytes(), spread[i:j].tobytes(), docs[a:z].tobytes(), said[a:z].tobytes())
            cells.append((self.number, b, *part, None, None))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*cells), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def _frequencies(path: str, chunk_chars: int, buckets: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, schema = _Splitter(path), _row_schema(id_type)
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number, buckets)
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py()
                chunk.add(id_, text, split(text))
                if chunk.chars >= chunk_chars or len(chunk.ids) >= CHUNK_DOCS:
                    yield chunk.rows(schema)
                    number += 1
                    chunk = _Chunk(number, buckets)
        if chunk.ids:
            yield chunk.rows(schema)

    return run


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 128) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, at_once):
            yield from batch.slice(i, at_once).to_pylist()


def _sum_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("chunk", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(id_type)), ("sizes", pa.list_(pa.int64())), ("sums", pa.binary())]
    )


def _count(path: str, id_type: pa.DataType):
    """Counts each pre-token of a bucket once, and sums each chunk's products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, schema = _tokenizer(path), _sum_schema(id_type)
        sums: dict[int, np.ndarray] = {}
        pieces_of: dict[str, int] = {}
        bucket, held = None, 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def told() -> pa.RecordBatch:
            return out([(chunk, 1, None, None, s.astype("<u8").tobytes()) for chunk, s in sums.items()])

        for row in _rows(batches):
            if row["tokens"] is None:
                yield out([(row["chunk"], 0, row["ids"], row["sizes"], None)])
                continue
            if row["bucket"] != bucket:
                bucket, pieces_of = row["bucket"], {}
            ends = np.cumsum(np.frombuffer(row["lengths"], "<u4")).tolist()
            text = row["tokens"]
            tokens = [text[a:b] for a, b in zip([0, *ends], ends)]
            if fresh := [t for t in tokens if t not in pieces_of]:
                encoded = library.encode_batch_fast(fresh, add_special_tokens=False)
                pieces_of.update(zip(fresh, map(len, encoded)))
            pieces = np.fromiter(map(pieces_of.__getitem__, tokens), np.int64, len(tokens))
            products = np.repeat(pieces, np.frombuffer(row["spread"], "<u4")) * np.frombuffer(row["freqs"], np.uint8)
            found = np.bincount(np.frombuffer(row["docs"], "<u2"), products).astype(np.int64)
            have = sums.get(row["chunk"], found[:0])
            held += max(0, len(found) - len(have))
            if len(have) < len(found):
                have, found = found, have
            have[: len(found)] += found
            sums[row["chunk"]] = have
            if held > SUMS_AT_ONCE:
                yield told()
                sums, held = {}, 0
        if sums:
            yield told()

    return run


def _gather(id_type: pa.DataType):
    """Per chunk its documents' ids and sizes, which come first, and the totals of the sums."""
    schema = pa.schema([("ids", pa.list_(id_type)), ("sizes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict | None = None
        totals = np.zeros(0, np.int64)

        def told() -> pa.RecordBatch:
            cells = (head["ids"], head["sizes"], totals.tolist())
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, schema)], schema=schema)

        for row in _rows(batches):
            if row["part"] == 0:
                if head is not None:
                    yield told()
                head, totals = row, np.zeros(len(row["ids"]), np.int64)
            else:
                found = np.frombuffer(row["sums"], "<u8").astype(np.int64)
                totals[: len(found)] += found
        if head is not None:
            yield told()

    return run


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS, buckets: int | None = None,
) -> DataFrame:
    """(id, n_bytes, n_tokens): one row per row of `docs`, counted as the library at `path` does.

    No begin or end tokens are added; an added token's string inside a text counts as
    that one token. Null texts count as empty, with zero tokens. Each row is counted
    in its own place, so rows may repeat and ids be null. Other columns are ignored;
    an empty table gives none. Without `buckets` their number follows the bytes of text.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches()
    given = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    if buckets is None:
        n_bytes = given.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        buckets = max(BUCKETS, n_bytes // BUCKET_BYTES)
    kind = given.schema["id"].dataType
    id_type, name = to_arrow_type(kind), kind.simpleString()
    rows = given.mapInArrow(
        _frequencies(path, chunk_chars, buckets, id_type),
        "chunk long, bucket int, tokens string, lengths binary, spread binary, docs binary, freqs binary, "
        f"ids array<{name}>, sizes array<long>",
    )
    sums = (
        rows.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_count(path, id_type), f"chunk long, part int, ids array<{name}>, sizes array<long>, sums binary")
    )
    counted = (
        sums.repartition("chunk").sortWithinPartitions("chunk", "part")
        .mapInArrow(_gather(id_type), f"ids array<{name}>, sizes array<long>, counts array<long>")
    )
    return counted.select(F.inline(F.arrays_zip("ids", "sizes", "counts"))).toDF("id", "n_bytes", "n_tokens")
