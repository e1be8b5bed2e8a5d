"""Ranked lexical search: for every query the k documents of highest score, over all rows.

Queries lie in the shared folder as a table of terms and weights and are read from there
in blocks by the tasks, so neither the driver nor a closure holds them. A task cuts its
documents into chunks of bounded size and keeps, of each chunk, the postings alone.

A query meets a chunk as bitmaps: one bit per document and matched term. Laid side by side
they give each document the mask of the query's terms that it holds, and documents of one
mask form a group. What a mask can score at most follows from the largest frequency and
the shortest document of each of its terms. Groups are scored exactly in the order of that
maximum, until the next one lies below the k-th score found. Chunks of a task share that
score as a floor. The best of all chunks meet by query, in two steps.

Null texts have no terms and are never found, and queries without terms find nothing. Each
row of the queries is answered by itself, so ids may repeat or be null. Documents may too:
each row is ranked, equal scores by ascending id, null ids last. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopgrid.llm.common import small_batches
from stopgrid.llm.warc import file_system
from stopgrid.session import shared_path

#: Bytes of text and documents that a chunk holds at most, but for a single longer text.
CHUNK_BYTES = 8_000_000
CHUNK_DOCS = 65_535  # places are kept in two bytes
#: Queries, and single terms of the vocabulary, that a task holds at once.
QUERY_BLOCK = 256
TERM_BLOCK = 65_536
#: Documents scored at once at least.
SCORED_AT_ONCE = 128
#: Groups of a query's finds that are ranked before they meet.
SPREAD = 64

#: A-Z lower-cased; 0-9, a-z and bytes beyond ASCII as they are; all others end a term.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return raw.translate(LETTERS).split() if raw else []


class Chunk:
    """Documents by their places, and the postings of their terms."""

    def __init__(self) -> None:
        self.n_bytes = 0
        self.sizes: list[int] = []
        self.place_of: dict[bytes, int] = defaultdict()
        self.place_of.default_factory = self.place_of.__len__
        self._seen: list[np.ndarray] = []
        self.ids: list[pa.Array] = []

    def add(self, raw: bytes | None) -> None:
        terms = terms_of(raw)
        self.n_bytes += len(raw or b"")
        self.sizes.append(len(terms))
        self._seen.append(np.fromiter(map(self.place_of.__getitem__, terms), np.uint32, len(terms)))

    def full(self, chunk_bytes: int) -> bool:
        return self.n_bytes >= chunk_bytes or len(self.sizes) >= CHUNK_DOCS

    def close(self) -> None:
        """Postings by term: the documents that hold it, ascending, and how often each does."""
        self.n_terms = np.array(self.sizes, np.int64)
        owner = np.repeat(np.arange(len(self.sizes), dtype=np.uint64), self.n_terms)
        seen = np.concatenate(self._seen).astype(np.uint64)
        pairs, freqs = np.unique(seen << np.uint64(16) | owner, return_counts=True)
        self.docs = (pairs & np.uint64(0xFFFF)).astype(np.int64)
        self.freqs = freqs.astype(np.int64)
        self.df = np.bincount((pairs >> np.uint64(16)).astype(np.int64), minlength=len(self.place_of))
        self.begin = np.concatenate([[0], np.cumsum(self.df)])
        self._seen = []

    def measure(self, n_docs: int, n_all: int) -> None:
        """Each document's length measure and, per term, the most that one occurrence list can give."""
        self.m = 100 - 75 + (75 * self.n_terms * n_docs) // max(n_all, 1)
        if len(self.docs):
            at = self.begin[:-1]
            most = np.maximum.reduceat(self.freqs, at)
            self.most = gain(most, np.minimum.reduceat(self.m[self.docs], at))

    def ranks(self) -> np.ndarray:
        """The place of each document among all by its id, null last."""
        ids = pa.chunked_array(self.ids) if self.ids else pa.array([], pa.int64())
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return rank


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's frequency in a document counts, before the term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best(chunk: Chunk, rank: np.ndarray, terms: list[bytes], weights: list[int], k: int, floor: int) -> list[tuple[int, int]]:
    """(place, score) of the chunk's k best documents for one query that score `floor` or more.

    `weights` are the terms' weights times their repeats in the query.
    """
    have = [(chunk.place_of[t], w) for t, w in zip(terms, weights) if t in chunk.place_of]
    if not have:
        return []
    places = [p for p, _ in have]
    weight = np.array([w for _, w in have], np.int64)
    bits = np.zeros((len(places), len(rank)), bool)
    for row, p in zip(bits, places):
        row[chunk.docs[chunk.begin[p] : chunk.begin[p + 1]]] = True
    matched = np.flatnonzero(bits.any(axis=0))
    # the bitmaps side by side: a document's mask, as bytes
    masks = np.ascontiguousarray(np.packbits(bits[:, matched], axis=0).T)
    keys = masks.view(np.dtype((np.void, masks.shape[1]))).ravel()
    distinct, group = np.unique(keys, return_inverse=True)
    held = np.unpackbits(distinct.view(np.uint8).reshape(len(distinct), -1), axis=1)[:, : len(places)]
    most = held.astype(np.int64) @ (weight * chunk.most[places])
    by_most = np.argsort(-most, kind="stable")
    members = matched[np.argsort(group, kind="stable")]
    edge = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(distinct)))])
    found_at, found_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    i = 0
    while i < len(by_most) and most[by_most[i]] >= max(floor, 1):
        taken, n = [], 0
        while i < len(by_most) and n < SCORED_AT_ONCE and most[by_most[i]] >= max(floor, 1):
            g = by_most[i]
            taken.append(members[edge[g] : edge[g + 1]])
            n += len(taken[-1])
            i += 1
        docs = np.sort(np.concatenate(taken))
        score = np.zeros(len(docs), np.int64)
        for row, p, w in zip(bits, places, weight.tolist()):
            holds = np.flatnonzero(row[docs])
            some = docs[holds]
            a, z = chunk.begin[p], chunk.begin[p + 1]
            tf = chunk.freqs[a + np.searchsorted(chunk.docs[a:z], some)]
            score[holds] += w * gain(tf, chunk.m[some])
        found_at, found_score = np.concatenate([found_at, docs]), np.concatenate([found_score, score])
        first = np.lexsort((rank[found_at], -found_score))[:k]
        found_at, found_score = found_at[first], found_score[first]
        if len(first) == k:
            floor = max(floor, int(found_score[-1]))
    keep = found_score >= max(floor, 1)
    return list(zip(found_at[keep].tolist(), found_score[keep].tolist()))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[Chunk]:
    chunk = Chunk()
    for batch in batches:
        begin = 0
        for i, raw in enumerate(batch.column("text").cast(pa.binary())):
            chunk.add(raw.as_py())
            if chunk.full(chunk_bytes):
                chunk.ids.append(batch.column("id").slice(begin, i + 1 - begin))
                chunk.close()
                yield chunk
                chunk, begin = Chunk(), i + 1
        chunk.ids.append(batch.column("id").slice(begin))
    if chunk.sizes:
        chunk.close()
        yield chunk


def _read(path: str, columns: list[str], at_once: int) -> Iterator[pa.RecordBatch]:
    """A table of the shared folder, a block at a time."""
    system, place = file_system(path)
    yield from ds.dataset(place, filesystem=system, format="parquet").to_batches(
        columns=columns, batch_size=at_once, batch_readahead=1, fragment_readahead=1
    )


def _counted(vocabulary: str, chunk_bytes: int):
    """Per chunk, the documents that hold each query term; without a term, documents with terms and all terms."""
    schema = pa.schema([("term", pa.binary()), ("df", pa.int64()), ("n_terms", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            totals = [[None], [int((chunk.n_terms > 0).sum())], [int(chunk.n_terms.sum())]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(totals, schema)], schema=schema)
            for block in _read(vocabulary, ["term"], TERM_BLOCK):
                here = [t for t in block.column(0).to_pylist() if t in chunk.place_of]
                df = [int(chunk.df[chunk.place_of[t]]) for t in here]
                cells = [here, df, [0] * len(here)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema)], schema=schema)

    return run


def _ranked(queries: str, n_docs: int, n_all: int, k: int, chunk_bytes: int, id_type: pa.DataType):
    schema = pa.schema([("key", pa.int64()), ("id", id_type), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, int] = {}
        for chunk in _chunks(batches, chunk_bytes):
            chunk.measure(n_docs, n_all)
            rank = chunk.ranks()
            ids = pa.chunked_array(chunk.ids, id_type)
            for block in _read(queries, ["key", "terms", "weights"], QUERY_BLOCK):
                keys, places, scores = [], [], []
                for row in block.to_pylist():
                    found = best(chunk, rank, row["terms"], row["weights"], k, floors.get(row["key"], 0))
                    if len(found) == k:
                        floors[row["key"]] = found[-1][1]
                    keys += [row["key"]] * len(found)
                    places += [p for p, _ in found]
                    scores += [s for _, s in found]
                named = ids.take(pa.array(places, pa.int64())).combine_chunks()
                named = named if isinstance(named, pa.Array) else pa.concat_arrays(named.chunks or [pa.array([], id_type)])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), named, pa.array(scores, pa.int64())], schema=schema)

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, term, repeats) of each query."""
    for batch in batches:
        keys, terms, repeats = [], [], []
        for key, raw in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            counts: dict[bytes, int] = defaultdict(int)
            for t in terms_of(raw):
                counts[t] += 1
            keys += [key] * len(counts)
            terms += counts.keys()
            repeats += counts.values()
        arrays = [pa.array(keys, pa.int64()), pa.array(terms, pa.binary()), pa.array(repeats, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "term", "repeats"])


def weight(df: Column, n_docs: int) -> Column:
    """A term's weight: 1000 times the logarithm of its rarity, rounded down."""
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2.0) * df + 1)))


def _written(rows: DataFrame, label: str) -> str:
    path = shared_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return path


def search(
    spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10,
    id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(key, query, rank, id, score): of each row of `queries` its best k rows of `docs`, score above 0.

    `key` numbers the rows of the queries, `query` is their id.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches()
    asked = queries.select(
        F.monotonically_increasing_id().alias("key"), F.col(f"`{query_id}`").alias("query"),
        F.col(f"`{query_text}`").cast("string").alias("text"),
    )
    asked = spark.read.schema("key long, query " + asked.schema["query"].dataType.simpleString() + ", text string").parquet(
        _written(asked, "search-queries")
    )
    terms = spark.read.schema("key long, term binary, repeats long").parquet(
        _written(asked.select("key", "text").mapInArrow(_query_terms, "key long, term binary, repeats long"), "search-terms")
    )
    vocabulary = _written(terms.select("term").distinct(), "search-vocabulary")
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = given.mapInArrow(_counted(vocabulary, chunk_bytes), "term binary, df long, n_terms long")
    sums = counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n_terms").alias("n_terms"))
    stats = spark.read.schema("term binary, df long, n_terms long").parquet(_written(sums, "search-statistics"))
    totals = stats.where("term is null").first()
    n_docs, n_all = (totals["df"], totals["n_terms"]) if totals else (0, 0)
    weighted = (
        terms.join(stats.select("term", "df"), "term")
        .withColumn("weight", F.col("repeats") * weight(F.col("df"), n_docs))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("found"))
        .select("key", F.col("found.term").alias("terms"), F.col("found.weight").alias("weights"))
    )
    known = _written(weighted, "search-weights")
    id_kind = given.schema["id"].dataType
    best_of_chunks = given.mapInArrow(
        _ranked(known, n_docs, n_all, k, chunk_bytes, to_arrow_type(id_kind)),
        f"key long, id {id_kind.simpleString()}, score long",
    )
    order = [F.desc("score"), F.asc_nulls_last("id")]
    part = F.pmod(F.spark_partition_id(), F.lit(SPREAD))
    some = best_of_chunks.withColumn("part", part)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("key", "part").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(asked.select("key", "query"), "key").select("key", "query", "rank", "id", "score")
