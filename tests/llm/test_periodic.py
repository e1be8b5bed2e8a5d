"""Runs beside trying every period at every place."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stopgrid.llm import periodic


def brute(words, least):
    """(start, length, period): maximal stretches of each period, the smallest period of each."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1) if j == i else j + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def both_ways(words, least):
    (told, found), = periodic.runs_of_texts([b" ".join(words)], least)
    assert told == words
    assert found == periodic.runs_of(words, least) == brute(words, least)
    return found


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), st.sampled_from([2, 5, 12]))
def test_any_words(words, least):
    both_ways(words, least)


def test_repeated_parts():
    rng = random.Random(3)
    for _ in range(400):
        piece = [rng.choice([b"x", b"y", b"z", b"w"]) for _ in range(rng.randint(1, 12))]
        words = [b"s"] * rng.randint(0, 3) + piece * rng.randint(1, 6) + piece[: rng.randint(0, len(piece))] + [b"t"]
        both_ways(words * rng.randint(1, 3), rng.choice([2, 6, 12]))


def test_length_and_period_bounds():
    word = [f"w{i}".encode() for i in range(30)]
    assert both_ways(word[:6] * 2, 12) == [(0, 12, 6)]
    assert both_ways(word[:6] * 2 + word[7:20], 12) == [(0, 12, 6)]
    assert both_ways(word[:5] * 2 + word[:1], 12) == []
    assert both_ways([b"a"] * 11, 12) == [] and both_ways([b"a"] * 12, 12) == [(0, 12, 1)]
    assert both_ways(word[:20] * 2, 12) == [(0, 40, 20)]
    assert both_ways(word[:20] + word[:19], 12) == []


def test_long_and_repetitive_texts():
    """Time does not grow with the square of a repetition."""
    assert periodic.runs_of([1] * 100_000) == [(0, 100_000, 1)]
    assert periodic.runs_of([i % 777 for i in range(50_000)]) == [(0, 50_000, 777)]


def test_texts_do_not_meet():
    piece = b"a b c d e f"
    found = [runs for _, runs in periodic.runs_of_texts([piece, piece, None, b"", piece + b" " + piece], 12)]
    assert found == [[], [], [], [], [(0, 12, 6)]]


def test_collapse():
    words = b"p a b a b a b a b a b a b q".split()
    (_, runs), = periodic.runs_of_texts([b" ".join(words)])
    assert runs == [(1, 12, 2)] and periodic.collapse(words, runs) == b"p a b q"


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "é " * 12), (None, "a\tb\x0bc\nd\re\x0cf " * 2), (4, "é " * 12), (7, "A a " * 6), (8, "ab " * 30000)]


def test_column(spark, make_docs, clash):
    docs = make_docs(ODD)
    rows = docs.select("doc_id", periodic.periodic_runs(F.col("text")).alias("f")).select("doc_id", "f.*").collect()
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows), key=str)
    assert found == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 12, [(0, 12, 1)], "é"), (4, 12, [(0, 12, 1)], "é"),
        (None, 12, [(0, 12, 6)], "a b c d e f"), (7, 12, [(0, 12, 2)], "A a"), (8, 30000, [(0, 30000, 1)], "ab"),
    ], key=str)
    assert docs.limit(0).select(periodic.periodic_runs(F.col("text"))).count() == 0
    clashing = clash([(1, "a " * 12)], runs="r", start="s", n_words="n", collapsed="c")
    assert clashing.select(periodic.periodic_runs(F.col("text")).alias("f")).first()["f"]["collapsed"] == "a"
    with pytest.raises(ValueError):
        periodic.periodic_runs(F.col("text"), 1)
