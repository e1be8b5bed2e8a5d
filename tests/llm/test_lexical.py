"""Ranked search beside scoring every document for every query."""

import math
import random
import re

import pytest

from stopgrid.llm import lexical

ITEMS = "item_id long, text string"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [t.lower() for t in TERM.findall((text or "").encode())]


def brute(docs, items, k=10):
    """(item id, rank, doc id, score), every pair scored."""
    held = [(i, plain_terms(t)) for i, t in docs]
    n_docs, n_all = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    rows = []
    for item, text in items:
        scored = []
        for i, w in held:
            score = 0
            for t in plain_terms(text):
                if tf := w.count(t):
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + 75 * len(w) * n_docs // n_all)))
            if score > 0:
                scored.append((-score, i is None, i))
        rows += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(rows, key=str)


def searched(spark, docs, items, **more):
    found = lexical.search(spark, docs, spark.createDataFrame(items, ITEMS), **more)
    assert found.columns == ["key", "query", "rank", "id", "score"]
    return sorted(((r["query"], r["rank"], r["id"], r["score"]) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(60)], k=rng.randint(0, 60)))) for i in range(150)]
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 30)) + rng.choices(words[:3], k=3))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("chunk_bytes", [200, lexical.CHUNK_BYTES])
@pytest.mark.parametrize("k", [1, 3, 10])
def test_beside_brute_force(spark, make_docs, made, chunk_bytes, k, monkeypatch):
    docs, items = made
    assert searched(spark, make_docs(docs), items, k=k, chunk_bytes=chunk_bytes) == brute(docs, items, k)


def test_groups_are_left_unscored_when_safe(monkeypatch):
    """Masks below the best found are not scored; the answer is that of all."""
    chunk = lexical.Chunk()
    texts = [b"rare common"] * 3 + [b"common"] * 500 + [b"other"] * 200
    for t in texts:
        chunk.add(t)
    chunk.close()
    chunk.measure(len(texts), 1100)
    scored = []
    real = lexical.gain
    monkeypatch.setattr(lexical, "gain", lambda tf, m: scored.append(len(m)) or real(tf, m))
    monkeypatch.setattr(lexical, "SCORED_AT_ONCE", 1)
    import numpy as np

    found = lexical.best(chunk, np.arange(len(texts)), [b"rare", b"common"], [5000, 10], 3, 0)
    assert [p for p, _ in found] == [0, 1, 2]
    assert sum(scored) < 20


def test_odd_rows(spark, make_docs):
    """Nulls, empty and long texts, ties and repeats on both sides."""
    docs = [(5, "alpha beta"), (3, "Alpha BETA"), (None, "alpha beta"), (None, "alpha beta"), (3, "alpha beta"), (7, None), (8, ""),
            (9, "... ---"), (10, "alpha " * 20000 + "ünïcode"), (11, "ÜNÏCODE x")]
    items = [(1, "alpha beta beta"), (1, "alpha beta beta"), (2, None), (None, "ünïcode ?"), (4, "nothing of that"), (5, "")]
    assert searched(spark, make_docs(docs), items) == brute(docs, items)
    many = [(i, "copy of one text") for i in range(400)] + [(-1, "copy")]
    assert searched(spark, make_docs(many), [(1, "copy text")]) == brute(many, [(1, "copy text")])


def test_nothing(spark, make_docs):
    assert searched(spark, make_docs([]), [(1, "a b")]) == []
    assert searched(spark, make_docs([(1, "a b")]), [(1, None)]) == []
    assert searched(spark, make_docs([(1, None)]), [(1, "a")]) == []


def test_clashing_columns_and_string_ids(spark, clash):
    docs = clash([(1, "some text"), (2, "some")], key="k", score="s", rank="r", id="i", part="p", query="q", term="t")
    assert [r[:3] for r in searched(spark, docs, [(1, "some text")])] == [(1, 1, 1), (1, 2, 2)]
    named = docs.selectExpr("concat('d', doc_id) as doc_id", "text", "key")
    found = lexical.search(spark, named, spark.createDataFrame([("q", "text")], "item_id string, text string"))
    assert [(r["query"], r["rank"], r["id"]) for r in found.collect()] == [("q", 1, "d1")]
