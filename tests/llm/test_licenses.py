"""Places, labels and scores beside a search at every place."""

import math
import re

import pytest

from stopgrid.llm import licenses


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts, min_score=licenses.MIN_SCORE):
    known = licenses.postings()
    every = [words(t) for t in texts]
    df = {w: sum(w in x for x in every) for p in known for w in p.words}
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in df.items()}
    out = []
    for x in every:
        starts, base, labels, best = [], set(), set(), 0.0
        for p in known:
            for s in range(-len(p.words), len(x)):
                met = [0 <= s + i < len(x) and x[s + i] == w for i, w in enumerate(p.words)]
                score = sum(idf[w] for w, m in zip(p.words, met) if m) / sum(idf[w] for w in p.words)
                if all(m for m, must in zip(met, p.must) if must) and score >= min_score:
                    labels.add(p.label)
                    best = max(best, score)
                    if p.base:
                        starts.append(s)
                        base.add(p.label)
        first, last = (min(starts), max(starts)) if starts else (None, None)
        out.append((len(x), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), round(best, 9)))
    return out


TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.",
    "This work was licensed under the GNU General Public License, version 3.",
    "GNU general public license GNU General Public License",
    "gnu general public", "Released under the MIT License. mit-license MIT\nLICENSE", "the mit licenses",
    "Licensed under CC BY-NC 4.0.", "cc by cc by", "CC: BY", "ccby", "apache license, version 2.0 Apache License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation FILES", "all rights reserved", "All Rights, reserved", None, "", "...", "été ÉTÉ license",
    "word " * 30_000 + "mit license", "mit license " * 400,
]


@pytest.mark.parametrize("min_score", [0.5, licenses.MIN_SCORE])
def test_scan(make_docs, min_score):
    docs = make_docs(list(enumerate(TEXTS)))
    rows = {r["id"]: r for r in licenses.scan(docs, min_score=min_score).collect()}
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    for i, expected in enumerate(plain(TEXTS, min_score)):
        assert (*(rows[i][n] for n in names), round(rows[i]["score"], 9)) == expected, TEXTS[i]


def test_own_templates(make_docs):
    templates = [licenses.Template("own", "do what you like with this", ("what you like",))]
    docs = make_docs([(1, "Do what you like with this!"), (2, "what you like"), (3, "mit license")])
    found = {r["id"]: (r["labels"], r["n_base"]) for r in licenses.scan(docs, {}, templates, 0.9).collect()}
    assert found == {1: ("own", 0), 2: ("", 0), 3: ("", 0)}
    with pytest.raises(ValueError, match="not in its text"):
        licenses.postings({}, [licenses.Template("bad", "some text", ("other",))])
    with pytest.raises(ValueError, match="no mandatory"):
        licenses.postings({}, [licenses.Template("bad", "some text", ())])


def test_repeats_nulls_and_clashing_columns(make_docs, clash):
    rows = [(1, "mit license"), (1, "mit license"), (None, "mit license"), (1, "other")]
    found = sorted(((r["id"], r["n_base"]) for r in licenses.scan(make_docs(rows)).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (None, 1), (1, 0)], key=str)
    assert licenses.scan(make_docs([])).count() == 0
    docs = clash([(1, "mit license")], words="w", id="i", found="f", places="p")
    assert [(r["id"], r["n_base"]) for r in licenses.scan(docs).collect()] == [(1, 1)]
