"""Benchmark decontamination: an FM-index per shard of the training texts.

Test phrases are the windows of `width` words of each benchmark item; an item with
fewer words is one phrase. Each shard is a bounded run of texts. It is indexed over
the words of the phrases, all other words separating, and every phrase is found by
backward search, its occurrences by sampled places. Overlapping occurrences merge into
spans. The benchmark is worked through in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from stopgrid.llm.common import free_name, small_batches, text_of
from stopgrid.llm.fm_index import LIMIT, FmIndex

WIDTH = 10
#: Words of benchmark items in a block: what the driver holds and sends at once.
BLOCK_WORDS = 400_000
#: Words of texts indexed at once.
SHARD_WORDS = LIMIT - 1

_word = re.compile(rb"[0-9a-z\x80-\xff]+")

def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return _word.findall(text.encode("utf-8", "surrogatepass").lower())


class Phrases:
    """The windows of a block of items, over ids of their words from 1 on."""

    def __init__(self, items: list[tuple[int, str]], width: int):
        self.id_of: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            ids = [self.id_of.setdefault(w, len(self.id_of) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                windows[tuple(ids[i : i + width])].add(item)
        self.width = max(map(len, windows), default=0)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.ids = np.zeros((len(windows), self.width), np.int32)
        for row, window in zip(self.ids, windows):
            row[: len(window)] = window
        self.items = [sorted(found) for found in windows.values()]

    def __len__(self) -> int:
        return len(self.items)


def _shards(sizes: list[int], overlap: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of (text, first word, last word) that one index holds with a separator behind each.

    A text too long for one index is cut into pieces that share `overlap` words.
    """
    shard: list[tuple[int, int, int]] = []
    room = SHARD_WORDS
    for text, size in enumerate(sizes):
        at = 0
        while at < size:
            if shard and size - at + 1 > room:
                yield shard
                shard, room = [], SHARD_WORDS
            end = min(size, at + room - 1)
            shard.append((text, at, end))
            room -= end - at + 1
            if end == size:
                break
            at = end - overlap
    if shard:
        yield shard


def search_texts(texts: list[str], phrases: Phrases) -> list[tuple[int, np.ndarray, set[int]]]:
    """Per text the number of words, which of them are hit (empty if none), and the items found."""
    ids, sizes = [], []
    for text in texts:
        words = words_of(text)
        ids.append(np.fromiter(map(phrases.id_of.get, words, repeat(0)), np.int32, len(words)))
        sizes.append(len(words))
    hits: dict[int, np.ndarray] = {}
    items: dict[int, set[int]] = defaultdict(set)
    for shard in _shards(sizes, phrases.width - 1) if len(phrases) else ():
        begins = np.cumsum([0, *(b - a + 1 for _, a, b in shard)])
        words = np.zeros(begins[-1], np.int32)
        for begin, (text, a, b) in zip(begins, shard):
            words[begin : begin + b - a] = ids[text][a:b]
        index = FmIndex(words, len(phrases.id_of))
        low, high = index.search(phrases.ids, phrases.lengths)
        found = np.flatnonzero(high > low)
        counts = high[found] - low[found]
        if not len(found):
            continue
        rows = np.repeat(low[found] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        phrase = np.repeat(found, counts)
        places = index.locate(rows)
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, places, 1)
        np.add.at(edges, places + phrases.lengths[phrase], -1)
        hit = np.cumsum(edges[:-1]) > 0
        piece = np.searchsorted(begins, places, "right") - 1
        for p in np.unique(piece):
            text, a, b = shard[p]
            mine = hits.setdefault(text, np.zeros(sizes[text], bool))
            mine[a:b] |= hit[begins[p] : begins[p] + b - a]
        for p, w in np.unique(np.stack([piece, phrase], 1), axis=0):
            items[shard[p][0]].update(phrases.items[w])
    none = np.zeros(0, bool)
    return [(size, hits.get(i, none), items.get(i, set())) for i, size in enumerate(sizes)]


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges[::2].astype(np.int32), edges[1::2].astype(np.int32)


def without_spans(text: str, starts: np.ndarray, ends: np.ndarray) -> str:
    """The text without the words [start, end) of each span and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    bounds = [m.span() for m in _word.finditer(raw.lower())]
    kept, at = [], 0
    for a, b in zip(starts, ends):
        kept.append(raw[at : bounds[a][0]])
        at = bounds[b - 1][1]
    return (b"".join(kept) + raw[at:]).decode("utf-8", "surrogatepass")


def _search(text: Column, items: list[tuple[int, str]], width: int) -> Column:
    @pandas_udf("n_words long, starts array<int>, ends array<int>, items array<long>")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        phrases = Phrases(items, width)
        for texts in batches:
            rows = []
            for n, hit, found in search_texts([t or "" for t in texts], phrases):
                rows.append((n, *_spans(hit), np.array(sorted(found), np.int64)))
            yield pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return of_texts(text)


def _merge_spans(starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """Spans of several blocks, in any order, as disjoint ones."""
    rows = []
    for a, b in zip(starts, ends):
        if len(a) > 1:
            order = np.argsort(a, kind="stable")
            a, b = np.asarray(a)[order], np.maximum.accumulate(np.asarray(b)[order])
            first = np.append(True, a[1:] > b[:-1])
            a, b = a[first], b[np.append(first[1:], True)]
        rows.append((a, b))
    return pd.DataFrame(rows, columns=["starts", "ends"])


def _cut_texts(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    parts = zip(text, starts, ends)
    return pd.Series([None if t is None else without_spans(t, a, b) for t, a, b in parts], dtype=object)


def blocks(benchmark: DataFrame, block_words: int, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items a block at a time; an item is at least one block. Items without id or words give no phrases."""
    block: list[tuple[int, str]] = []
    held = 0
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).filter("id is not null")
    for item, text in items.distinct().orderBy("id", "text").toLocalIterator():
        block.append((item, text))
        held += len(words_of(text)) + 1
        if held >= block_words:
            yield block
            block, held = [], 0
    yield block


def search(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS,
    id_col: str = "item_id", text_col: str = "text", into: str = "hits",
) -> DataFrame:
    """`docs` with a column `into`: n_words, starts and ends of the word spans, items.

    Spans are disjoint and cover each word inside any occurrence of a phrase; items
    are the ids, ascending, of which a phrase occurs. Rows are independent of each
    other: repeated rows and null ids stay as they are, null texts have no words. An
    item that comes several times counts once, repeated phrases count for each of
    their items. A column already called `into` is replaced. Without items, or
    without texts, there are no hits.
    """
    small_batches()
    names = []
    out = docs
    for items in blocks(benchmark, block_words, id_col, text_col):
        names.append(free_name(out, f"found_{len(names)}"))
        out = out.withColumn(names[-1], _search(text_of(), items, width))
    if len(names) == 1:
        return out.withColumn(into, F.col(names[0])).drop(names[0])

    def joined(field: str) -> Column:
        return F.flatten(F.array(*(F.col(f"{n}.{field}") for n in names)))

    spans = free_name(out, "merged")
    merged = pandas_udf(_merge_spans, "starts array<int>, ends array<int>")
    out = out.withColumn(spans, merged(joined("starts"), joined("ends")))
    items = F.array_sort(F.array_distinct(joined("items")))
    whole = F.col(f"{names[0]}.n_words")
    hits = F.struct(whole.alias("n_words"), f"{spans}.starts", f"{spans}.ends", items.alias("items"))
    return out.withColumn(into, hits).drop(spans, *names)


def n_hit(hits: str = "hits") -> Column:
    """The number of words in the spans."""
    sizes = F.zip_with(f"{hits}.ends", f"{hits}.starts", lambda b, a: (b - a).cast("long"))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n)


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` with the spans cut out of the texts and n_chars, if there, brought in line.

    Texts without a hit, null ones among them, are untouched, and no row is lost.
    """
    hits = free_name(docs, "hits")
    cut = free_name(docs, "cut")
    found = search(docs, benchmark, width, into=hits)
    # only texts with a hit go to the second function
    hit = F.when(F.size(f"{hits}.starts") > 0, F.col("text"))
    found = found.withColumn(cut, pandas_udf(_cut_texts, "string")(hit, F.col(f"{hits}.starts"), F.col(f"{hits}.ends")))
    new = {"text": F.coalesce(F.col(cut), F.col("text"))}
    if "n_chars" in docs.columns:
        n_chars = F.char_length(cut).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col(cut).isNotNull(), n_chars).otherwise(F.col("n_chars"))
    return found.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
