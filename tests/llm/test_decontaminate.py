"""The index, the spans and the items beside a search of every window at every place."""

import random

import numpy as np
import pytest

from stopgrid.llm import decontaminate as dc
from stopgrid.llm.fm_index import FmIndex, suffix_array


def plain(text, items, width):
    words = dc.words_of(text or "")
    hit, found = [False] * len(words), set()
    for item, item_text in items:
        phrase = dc.words_of(item_text or "")
        n = min(width, len(phrase))
        for s in range(len(phrase) - n + 1 if phrase else 0):
            for k in range(len(words) - n + 1):
                if words[k : k + n] == phrase[s : s + n]:
                    hit[k : k + n] = [True] * n
                    found.add(item)
    return words, hit, found


def made(rng, n, vocabulary):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_and_search(seed):
    rng = random.Random(seed)
    top = rng.choice([1, 2, 5, 300])
    text = np.array([*(rng.choice([0, *range(1, top + 1)]) for _ in range(rng.choice([1, 40, 400]))), 0], np.int32)
    order = suffix_array(text, top)

    def suffix(p):  # separators differ, by place
        return [(s, 0) if s else (0, q) for q, s in enumerate(text[p:].tolist(), p)]

    assert order.tolist() == sorted(range(len(text)), key=suffix)
    index = FmIndex(text, top)
    phrases = [[rng.randint(1, top) for _ in range(rng.randint(1, 4))] for _ in range(20)]
    padded = np.array([p + [0] * (4 - len(p)) for p in phrases], np.int32)
    low, high = index.search(padded, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high):
        places = [k for k in range(len(text) - len(p) + 1) if text[k : k + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


@pytest.mark.parametrize("seed", range(20))
def test_texts_in_shards(monkeypatch, seed):
    """Also texts that one index cannot hold, cut into pieces that overlap."""
    rng = random.Random(seed)
    vocabulary, width = rng.choice([2, 3, 5, 30]), rng.choice([2, 3, 5, 10])
    texts = [made(rng, rng.choice([0, 1, 5, 30, 200]), vocabulary) for _ in range(8)]
    items = [(i, made(rng, rng.choice([0, 2, 3, 12, 20]), vocabulary)) for i in range(6)]
    items.append((9, " ".join(texts[3].split()[3:9])))
    monkeypatch.setattr(dc, "SHARD_WORDS", rng.choice([25, 60, 10_000]))
    for text, (n, hit, found) in zip(texts, dc.search_texts(texts, dc.Phrases(items, width))):
        words, expected, names = plain(text, items, width)
        assert (n, found) == (len(words), names)
        assert (hit.tolist() if len(hit) else [False] * n) == expected


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short item"),
    (3, "short item"),
    (3, "short item"),
    (4, "..."),
    (5, None),
    (None, "beta gamma"),
]
ROWS = [
    (1, "x Alpha, BETA gamma delta epsilon zeta eta theta iota kappa-lambda mu y"),
    (2, "Alpha beta gamma delta epsilon zeta eta theta iota"),
    (3, "a short ITEM. Another short\nitem!"),
    (3, "a short ITEM. Another short\nitem!"),
    (None, "short item"),
    (5, None),
    (6, ""),
    (7, "clean words only " * 20_000 + "short item"),
    (8, "été shortitem"),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block_words", [1, 3, 400_000])
def test_search(make_docs, benchmark, block_words):
    found = dc.search(make_docs(ROWS), benchmark, 10, block_words).withColumn("n", dc.n_hit())
    items = [(i, t) for i, t in ITEMS if i is not None]
    rows = found.select("doc_id", "text", "hits.*", "n").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        words, hit, names = plain(r["text"], items, 10)
        assert (r["n_words"], r["n"], r["items"]) == (len(words), sum(hit), sorted(names))
        mine = [False] * len(words)
        for a, b in zip(r["starts"], r["ends"]):
            assert a < b and not any(mine[a:b])
            mine[a:b] = [True] * (b - a)
        assert mine == hit


def test_spans_are_cut_out(make_docs, benchmark, clash):
    found = dc.remove_spans(make_docs(ROWS), benchmark)
    rows = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in found.collect()), key=str)
    expected = {
        "x  y": 1, ROWS[1][1]: 1, "a . Another !": 2, "": 2, "clean words only " * 20_000: 1, "été shortitem": 1,
    }
    texts = [t for _, t, _ in rows if t is not None]
    assert sorted(texts) == sorted(t for t, n in expected.items() for _ in range(n))
    assert all(n == (None if t is None else len(t)) for _, t, n in rows) and len(rows) == len(ROWS)
    docs = clash([(1, "a short item")], hits="h", cut="c", found_0="f", merged="m")
    cut = dc.remove_spans(docs, benchmark)
    assert cut.columns == docs.columns
    assert [(r["text"], r["hits"], r["cut"], r["found_0"]) for r in cut.collect()] == [("a ", "h", "c", "f")]


def test_nothing_to_search(spark, make_docs, benchmark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.search(make_docs([]), benchmark).count() == 0
    assert [r["n"] for r in dc.search(make_docs([(1, "a b")]), none).select(dc.n_hit().alias("n")).collect()] == [0]
