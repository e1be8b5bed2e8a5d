"""Licence scans over a positional index of rare words.

A template is a text with a label and mandatory phrases; a base phrase is one that is
mandatory as a whole. The templates' words and places are the postings, and words are
rated by IDF over the whole corpus. In a document the highest-IDF mandatory word of
each template is looked up; each place of it proposes a place of the template, by the
difference of the two places. The template's other words are met with the document's
at the same difference: all mandatory ones must stand there, and the share of the IDF
found is the score. As the word looked up is mandatory itself, no place is missed.

Only built-in functions are used, a document is settled within its row, and nothing
is shuffled but the word counts of each task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopgrid.llm.common import ascii_lower, text_of

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """A licence text. Each phrase of `mandatory` must stand whole, at its place in the text."""

    label: str
    text: str
    mandatory: tuple[str, ...]


#: Openings and notices of licences, in their usual wording.
TEMPLATES = (
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "This work is licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc0", "dedicated to the public domain under CC0 1.0", ("cc0 1 0",)),
    Template("mit-notice", "Released under the MIT License", ("under the mit license",)),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("all-rights-reserved", "All rights reserved", ("all rights reserved",)),
)

#: A template counts from this share of its words' IDF on.
MIN_SCORE = 0.8

#: Fixed value: a word of a text in which A-Z is lower-cased.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Posting:
    """A template's words, which of them are mandatory, and the place of its rarest mandatory one."""

    label: str
    base: bool
    words: tuple[str, ...]
    must: tuple[bool, ...]


def _words(text: str) -> tuple[str, ...]:
    return tuple("".join(c if c.isalnum() else " " for c in text.lower()).split())


def postings(base: dict[str, str] = BASE, templates: Sequence[Template] = TEMPLATES) -> list[Posting]:
    found = [Posting(label, True, words, (True,) * len(words)) for phrase, label in base.items() if (words := _words(phrase))]
    for template in templates:
        words = _words(template.text)
        must = [False] * len(words)
        for phrase in map(_words, template.mandatory):
            at = next((i for i in range(len(words)) if words[i : i + len(phrase)] == phrase), None)
            if at is None or not phrase:
                raise ValueError(f"{template.label}: {' '.join(phrase)!r} is not in its text")
            must[at : at + len(phrase)] = [True] * len(phrase)
        if not any(must):
            raise ValueError(f"{template.label} has no mandatory phrase")
        found.append(Posting(template.label, False, words, tuple(must)))
    return found


def inverse_frequencies(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """IDF of the words of the templates over all rows of `words`.

    The counts are as many as the templates have words, whatever the corpus.
    """
    known = F.array(*(F.lit(w) for w in vocabulary))
    in_row = words.select(F.explode(F.array_append(F.array_intersect("words", known), F.lit(""))).alias("word"))
    counts = {word: n for word, n in in_row.groupBy("word").count().collect()}
    total = counts.get("", 0)  # every row has the empty word once
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}


def _literal(values: Sequence) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _places(words: Column, anchors: dict[str, list[tuple[int, int]]]) -> Column:
    """The proposed places: (which template, its first word's place), for each place of a rare word."""
    rare = _literal(sorted(anchors))
    stands = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda x: F.array_contains(rare, x["word"])
    )
    index = F.array(
        *(
            F.struct(F.lit(word).alias("word"), F.lit(which).alias("which"), F.lit(place).alias("place"))
            for word, found in sorted(anchors.items())
            for which, place in found
        )
    )
    proposed = F.flatten(
        F.transform(
            stands,
            lambda x: F.transform(
                F.filter(index, lambda p: p["word"] == x["word"]),
                lambda p: F.struct(p["which"].alias("which"), (x["at"] - p["place"]).alias("start")),
            ),
        )
    )
    none = F.array().cast("array<struct<which:int,start:int>>")
    return F.when(F.arrays_overlap(words, rare), proposed).otherwise(none)


def scan(
    docs: DataFrame, base: dict[str, str] = BASE, templates: Sequence[Template] = TEMPLATES,
    min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score): one row per row of `docs`.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.
    n_base counts the places where a base phrase stands, first_word and last_word are
    the smallest and largest of them, null without one; labels also has those of the
    templates found. score is the best share of a template's IDF that was found, 0
    without one. Null texts have no words. Rows are independent, so repeated rows each
    get the same result and ids may be null or repeat; other columns are ignored, and
    an empty table gives none.
    """
    lower = ascii_lower(text_of(text_col))
    words = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("words")
    )
    known = postings(base, templates)
    idf = inverse_frequencies(words, sorted({w for p in known for w in p.words}))
    anchors: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for which, p in enumerate(known):
        place = max((i for i in range(len(p.words)) if p.must[i]), key=lambda i: (idf[p.words[i]], -i))
        anchors[p.words[place]].append((which, place))

    texts = F.array(*(_literal(p.words) for p in known))
    musts = F.array(*(_literal(p.must) for p in known))
    weights = F.array(*(_literal([idf[w] for w in p.words]) for p in known))
    wholes = _literal([sum(idf[w] for w in p.words) for p in known])

    def met(place: Column) -> Column:
        """Which of the template's words stand where they should."""
        text = F.get(texts, place["which"])
        return F.transform(text, lambda w, i: F.coalesce(F.get(F.col("words"), place["start"] + i) == w, F.lit(False)))

    def judged(place: Column) -> Column:
        hit = met(place)
        lacking = F.zip_with(hit, F.get(musts, place["which"]), lambda here, must: must & ~here)
        found = F.zip_with(hit, F.get(weights, place["which"]), lambda here, weight: F.when(here, weight).otherwise(F.lit(0.0)))
        whole = F.get(wholes, place["which"])
        return F.struct(
            F.get(_literal([p.label for p in known]), place["which"]).alias("label"),
            F.get(_literal([p.base for p in known]), place["which"]).alias("base"),
            place["start"].cast("long").alias("start"),
            (~F.exists(lacking, lambda x: x)).alias("whole"),
            (F.aggregate(found, F.lit(0.0), lambda total, x: total + x) / whole).alias("score"),
        )

    placed = words.select("id", "words", _places(F.col("words"), anchors).alias("places"))
    scored = placed.select(
        "id", F.size("words").cast("long").alias("n_words"),
        F.filter(F.transform("places", judged), lambda p: p["whole"] & (p["score"] >= min_score)).alias("found"),
    )
    of_base = F.filter("found", lambda p: p["base"])

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda p: p["label"]))), ",")

    return scored.select(
        "id", "n_words",
        F.size(of_base).cast("long").alias("n_base"),
        F.array_min(F.transform(of_base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(of_base, lambda p: p["start"])).alias("last_word"),
        labels(of_base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("found", lambda p: p["score"])), F.lit(0.0))).alias("score"),
    )
