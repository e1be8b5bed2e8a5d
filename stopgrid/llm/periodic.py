"""Periodic runs of words: a stretch that repeats itself with a period, twice at least.

A run's words are read one by one into a suffix automaton. Its link tree is kept as paths
of one colour, the place where the strings of a path last ended. Reading a word opens the
way from its state up to the root: each path segment met on the way tells how long a suffix
is and where it ended before. Where that was no further back than the suffix is long, two
equal halves stand side by side, a square. The whole way then takes the new place as its
colour. Paths are splay trees, so a word opens O(log n) segments on average, however long
and however repetitive a text is. A square outside the known run of its period is extended
to both sides, which gives the run. Roots of the squares found are never repetitions
themselves, so each run comes with its smallest period.

Every word of a run lies in a window of half the least length that occurs twice in the
text. Words outside such windows cannot be in a run and are taken out before.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from stopgrid.llm.common import small_batches

MIN_WORDS = 12
#: Odd numbers that spread word numbers and texts over 64 bits.
SPREAD_WORD = 0x9E3779B97F4A7C15
SPREAD_TEXT = 0xC2B2AE3D27D4EB4F
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class RunFinder:
    """Reads words as numbers and gathers the squares' runs."""

    def __init__(self, words: Sequence[int], min_words: int = MIN_WORDS):
        self.words = words
        self.min_words = min_words
        # automaton: transitions, suffix link and longest string of each state
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.longest = [0]
        # link tree: splay trees of paths, by depth; the parent of a tree's root is where its path hangs
        self.left, self.right, self.parent = [-1], [-1], [-1]
        #: Of a splay tree's root, where the strings of the path last ended.
        self.colour = [-1]
        self.known_end: dict[int, int] = {}
        self.runs: list[tuple[int, int, int]] = []
        last = 0
        for place, word in enumerate(words):
            last = self._append(last, word)
            self._open(last, place)

    def _state(self, longest: int, link: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.link.append(link)
        self.longest.append(longest)
        for x in (self.left, self.right, self.colour):
            x.append(-1)
        self.parent.append(link)
        return len(self.link) - 1

    def _append(self, last: int, word: int) -> int:
        """The state of the whole text read so far, with this word behind it."""
        next_, link, longest = self.next, self.link, self.longest
        new = self._state(longest[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in next_[p]:
            next_[p][word] = new
            p = link[p]
        if p >= 0:
            q = next_[p][word]
            if longest[q] != longest[p] + 1:
                copy = self._split(q, longest[p] + 1)
                while p >= 0 and next_[p].get(word) == q:
                    next_[p][word] = copy
                    p = link[p]
                q = copy
            link[new] = self.parent[new] = q
        return new

    def _split(self, q: int, longest: int) -> int:
        """A state for the shorter strings of `q`, right above it on the same path."""
        copy = self._state(longest, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        self._splay(q)
        above = self.left[copy] = self.left[q]
        if above >= 0:
            self.parent[above] = copy
        self.left[q], self.parent[copy] = copy, q
        return copy

    def _rotate(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        p = parent[x]
        g = parent[p]
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b >= 0:
            parent[b] = p
        parent[p], parent[x] = x, g

    def _splay(self, x: int) -> None:
        """Makes `x` the root of its path's tree; the colour moves with the root."""
        left, right, parent = self.left, self.right, self.parent
        while True:
            p = parent[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = parent[p]
            if g < 0 or (left[g] != p and right[g] != p):
                self.colour[x] = self.colour[p]
                self._rotate(x)
                return
            top = parent[g]
            if top < 0 or (left[top] != g and right[top] != g):
                self.colour[x] = self.colour[g]
            self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _open(self, state: int, place: int) -> None:
        """Makes the way from the root to `state` one path that ends at `place`, looking at each segment it takes."""
        below, at = -1, state
        while at >= 0:
            self._splay(at)
            ended = self.colour[at]
            if ended >= 0:
                distance = place - ended
                if distance <= self.longest[at] and self.known_end.get(distance, -1) < place:
                    self._extend(place, distance)
            if (deeper := self.right[at]) >= 0:
                self.colour[deeper] = ended  # goes on as a path of its own
            self.right[at] = below
            below, at = at, self.parent[at]
        self.colour[below] = place

    def _extend(self, place: int, period: int) -> None:
        """The run of a square of `period` that ends at `place`."""
        words = self.words
        start, end = place - 2 * period + 1, place + 1
        while start > 0 and words[start - 1] == words[start - 1 + period]:
            start -= 1
        while end < len(words) and words[end] == words[end - period]:
            end += 1
        self.known_end[period] = end - 1
        if end - start >= self.min_words:
            self.runs.append((start, end - start, period))


def runs_of(words: Sequence[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least `min_words`, by start, then period."""
    return sorted(RunFinder(words, min_words).runs, key=lambda r: (r[0], r[2]))


def repeated_stretches(words: np.ndarray, sizes: np.ndarray, width: int) -> Iterator[tuple[int, int, int]]:
    """(text, begin, end) of maximal stretches of places in windows of `width` words that occur twice in their text.

    `words` has the words of all texts one after another, `sizes` how many each has;
    begin and end count from the text's first word.
    """
    n = len(words)
    if n < width:
        return
    edge = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(sizes)), sizes)
    with np.errstate(over="ignore"):
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(SPREAD_WORD)
        mixed ^= mixed >> np.uint64(29)
        key = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            key = key * np.uint64(SPREAD_WORD) + mixed[j : j + len(key)]
        key = key * np.uint64(SPREAD_WORD) + text[: len(key)].astype(np.uint64) * np.uint64(SPREAD_TEXT)
    at = np.flatnonzero(text[: len(key)] == text[width - 1 :])
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begins = order[twice]
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + width, -1)
    inside = np.cumsum(cover[:-1]) > 0
    # a stretch ends where its text does
    begin = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | (text[1:] != text[:-1])])
    end = np.flatnonzero(inside & np.r_[~inside[1:] | (text[1:] != text[:-1]), True]) + 1
    for a, z in zip(begin.tolist(), end.tolist()):
        t = int(text[a])
        yield t, a - int(edge[t]), z - int(edge[t])


def runs_of_texts(texts: Sequence[bytes | None], min_words: int = MIN_WORDS) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and their runs."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    split = [t.split() if t else [] for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.uint32, int(sizes.sum()))
    edge = np.concatenate([[0], np.cumsum(sizes)])
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for text, begin, end in repeated_stretches(words, sizes, max(min_words // 2, 1)):
        if end - begin >= min_words:
            stretch = words[edge[text] + begin : edge[text] + end].tolist()
            found[text] += [(begin + start, length, period) for start, length, period in runs_of(stretch, min_words)]
    for t, s in enumerate(split):
        yield s, found.get(t, [])


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one blank between, without those that a run holds after its first period."""
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [w for w, g in zip(words, gone.tolist()) if not g]
    return b" ".join(words)


def periodic_runs(text: Column, min_words: int = MIN_WORDS) -> Column:
    """(n_words, runs, collapsed) of a text column; runs are (start, length, period) by start, then period.

    Words are what stands between blanks, tabs and line ends, numbered from 0. A run is a
    stretch of at least `min_words` and at least two periods that no neighbouring word
    extends. `collapsed` has the text's words, one blank between, without those that some
    run holds after its first period. Null counts as an empty text: no runs, nothing
    collapsed. Rows are independent, so repeated rows and ids, other columns and empty
    tables need no care. A passage that repeats itself takes some 600 bytes a word while
    its text is read.
    """
    if min_words < 2:
        raise ValueError("a run has two words at least")
    small_batches()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    @arrow_udf(RESULT)
    def of_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n_words, runs, collapsed = [], [], []
            for words, found in runs_of_texts(batch.cast(pa.binary()).to_pylist(), min_words):
                n_words.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                collapsed.append(collapse(words, found))
            columns = [pa.array(n_words, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_words", "runs", "collapsed"])

    return of_texts(text)
