"""Near-duplicate texts by SimHash: fingerprints of word shingles, compared tile by tile.

Every pair of different fingerprints that may lie within the radius is compared, by
exclusive-or and a count of the bits that remain. Fingerprints of one tile have the
same number of bits set in each half, so a pair of tiles is skipped when these
population counts differ by more than the radius. A pair of tiles passes on a
spanning forest of its links, never all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from stopgrid.llm.common import free_name, small_batches, text_of
from stopgrid.llm.components import components
from stopgrid.session import stored

SEED = 42
TILE = 16384
HASHES_AT_ONCE = 65536


def fingerprint_of(text: str, width: int) -> int:
    """The signed 64-bit fingerprint of one text; zero where it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    last = ends[width - 1 :] - 1 if len(words) >= width else ends[-1:] - 1
    first = starts[: len(last)].tolist()
    last = last.tolist()
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), HASHES_AT_ONCE):
        spans = zip(first[at : at + HASHES_AT_ONCE], last[at : at + HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(first)).view(np.int64)[0])


def fingerprint(text: Column, width: int = 4) -> Column:
    """Fingerprint of a text column as a long; null counts as an empty text."""
    small_batches()

    @pandas_udf("long")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t or "", width) for t in texts], dtype="int64")

    return of_texts(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what the pairs within the radius join, fewer than there are values."""
    same = left is right
    values = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    root = np.arange(len(values))
    links: list[tuple[int, int]] = []
    rows, cols = 64, 4096
    gap = np.empty((rows, cols), np.uint64)
    count = np.empty((rows, cols), np.uint8)
    for i in range(0, len(left), rows):
        a = left[i : i + rows, None]
        for j in range(i // cols * cols if same else 0, len(right), cols):
            b = right[None, j : j + cols]
            x, n = gap[: a.shape[0], : b.shape[1]], count[: a.shape[0], : b.shape[1]]
            np.bitwise_xor(a, b, out=x)
            np.bitwise_count(x, out=n)
            near = n <= radius
            if not near.any():
                continue
            u, v = np.nonzero(near)
            u, v = u + i, v + j + shift
            while True:
                ru, rv = root[u], root[v]
                apart = ru != rv
                if not apart.any():
                    break
                u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
                # each root hooks once a turn, to a smaller one, so no cycle can close
                high, low = np.maximum(ru, rv), np.minimum(ru, rv)
                hooks, at = np.unique(high, return_index=True)
                root[hooks] = low[at]
                links.extend(zip(values[u[at]].tolist(), values[v[at]].tolist()))
                while not np.array_equal(up := root[root], root):
                    root = up
    return links


def _tile_links(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = []
            for a, b, same in zip(batch["a"], batch["b"], batch["same"]):
                left = np.asarray(a, np.int64).view(np.uint64)
                right = left if same else np.asarray(b, np.int64).view(np.uint64)
                links += _forest(left, right, radius)
            yield pd.DataFrame(np.array(links, np.uint64).reshape(-1, 2).view(np.int64), columns=["u", "v"])

    return run


def links(prints: DataFrame, radius: int) -> DataFrame:
    """(u, v): links that connect all fingerprints `fp` of `prints` within `radius` bits.

    `prints` holds each fingerprint once. There are at most 33 x 33 classes by the
    population counts of the halves, so their sizes may be broadcast. A large class is
    dealt into tiles by hash, and each pair of tiles that may match meets in one row.
    """
    tiled = prints.select(
        "fp",
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("high"),
        F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )
    parts = F.ceil(F.count("*") / TILE).cast("int")
    classes = stored(tiled.groupBy("high", "low").agg(parts.alias("parts")), "classes")
    tiles = stored(
        tiled.join(F.broadcast(classes), ["high", "low"])
        .groupBy("high", "low", F.expr("cast(pmod(xxhash64(fp), parts) as int)").alias("part"))
        .agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    reach = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
    meets = (
        tiles.select("high", "low", "part", "fps", reach.alias("dh"))
        .select("*", reach.alias("dl"))
        .filter(F.abs("dh") + F.abs("dl") <= radius)
        .select("part", F.col("fps").alias("a"), F.col("high").alias("ah"), F.col("low").alias("al"),
                (F.col("high") + F.col("dh")).alias("high"), (F.col("low") + F.col("dl")).alias("low"))
        .filter((F.col("ah") < F.col("high")) | ((F.col("ah") == F.col("high")) & (F.col("al") <= F.col("low"))))
        .join(F.broadcast(classes), ["high", "low"])
        .select("*", F.col("part").alias("ap"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("bp"))
        .drop("part", "parts")
        .withColumn("same", (F.col("ah") == F.col("high")) & (F.col("al") == F.col("low")) & (F.col("ap") == F.col("bp")))
        .filter((F.col("ah") != F.col("high")) | (F.col("al") != F.col("low")) | (F.col("ap") <= F.col("bp")))
    )
    others = tiles.select("high", "low", F.col("part").alias("bp"), F.col("fps").alias("b"))
    pairs = meets.join(others, ["high", "low", "bp"])
    return pairs.select("a", "b", "same").mapInPandas(_tile_links(radius), "u long, v long")


def near_duplicates(
    docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp, component_id, n_links): one row per row of `docs`.

    component_id is the smallest id whose text is reached over links of at most
    `radius` bits. Null texts count as empty and, like all texts without words, have
    fingerprint zero, which is linked like any other. Repeated rows each come back;
    null ids are never the smallest, and a component of null ids only has a null
    component_id. Other columns of `docs` are ignored. An empty table gives none.
    """
    marked = stored(
        docs.select(F.col(f"`{id_col}`").alias("id"), fingerprint(text_of(text_col), width).alias("fp")), "prints"
    )
    prints = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    roots = components(links(prints, radius))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """`docs` with one document of each group, that with the smallest doc_id.

    Rows without doc_id stay. Of repeated rows with the smallest id each stays, as
    nothing tells them apart. Columns and their order are kept.
    """
    id_, component = free_name(docs, "keep_id"), free_name(docs, "keep_component")
    groups = near_duplicates(docs, width, radius)
    kept = groups.filter("id = component_id").select(F.col("id").alias(id_)).distinct()
    stay = docs.join(kept, docs["doc_id"] == kept[id_], "left_semi")
    return stay.unionByName(docs.filter("doc_id is null")).drop(component)
