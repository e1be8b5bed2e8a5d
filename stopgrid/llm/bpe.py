"""BPE with word ends, encoded by backtracking and decoded by an offset table.

An encoding is right exactly when each pair of neighbouring tokens is compatible,
that is, when merging the symbols of both gives these two tokens again. The encoder
takes the longest token at each place, found by an Aho-Corasick automaton, as long as
it is compatible with the one before, else a shorter one, and steps back where none
fits. A place found to be a dead end is not entered again, so the time is linear.

Symbols are the byte-level characters; the last one of a word carries the word end.
Each symbol is one character here, so tokens are plain strings.
"""

from __future__ import annotations

import array
import functools
import hashlib
import heapq
import json
import os
import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.pandas.functions import pandas_udf

from stopgrid.llm.common import small_batches

#: Added to a character's code where the word ends with it.
END = 0x10000
NEVER = 1 << 60
#: Two token ids in one number: the left one is moved up by so many bits.
PAIR_BITS = 24
#: Words whose ids are kept, in two halves: when the newer is full it becomes the older, and words still in use move on.
CACHED_WORDS = 300_000
CACHED_CHARS = 64
CACHED_PAIRS = 400_000
#: Ids that a worker holds before it passes rows on.
IDS_AT_ONCE = 1_000_000
#: Characters whose lower case, composition and classes are the same everywhere.
COMMON = re.compile(r"[\t\n\r\x20-\x7eÀ-ÿ]*")
#: Fixed value: how the vocabulary's library splits lower-case text, for those characters.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder and decoder for a tokenizer file with the `</w>` word end.

    The tables take about two seconds and some 40 MB. They are made once in a Python
    worker (`coder`); a task begins with empty caches and leaves them empty.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.suffix = spec["model"]["end_of_word_suffix"]
        characters = byte_characters()
        self.characters = {b: c for b, c in characters.items() if chr(b) != c}
        self.last = [chr(ord(characters[b]) + (END if self.suffix else 0)) for b in range(256)]
        vocabulary = spec["model"]["vocab"]
        self.id_of = {self._symbols(t): i for t, i in vocabulary.items()}
        self.rank: dict[int, int] = {}
        self.made_by: list[int] = []
        for k, pair in enumerate(spec["model"]["merges"]):
            left, right = (self._symbols(t) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            self.rank[self.id_of[left] << PAIR_BITS | self.id_of[right]] = k
            self.made_by.append(self.id_of[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ordered = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self._learn_tokens()
        self._offsets({i: t for t, i in vocabulary.items()} | {i: t for t, i in self.added.items()})
        self.forget()

    def forget(self) -> None:
        """Empties the caches."""
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + END)
        return token

    def merge(self, symbols: str) -> tuple[list[int], dict[int, tuple[int, int, int]]]:
        """Merges by rank, leftmost first: the tokens left, and the (left, right, rank) of each one made."""
        ids = [self.id_of[c] for c in symbols]
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        made: dict[int, tuple[int, int, int]] = {}
        pairs = [a << PAIR_BITS | b for a, b in zip(ids, ids[1:])]
        heap = [(self.rank[p], i, p) for i, p in enumerate(pairs) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            left, right = pair >> PAIR_BITS, pair & ((1 << PAIR_BITS) - 1)
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = self.made_by[rank], -1
            made[ids[i]] = (left, right, rank)
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (next_ := ids[a] << PAIR_BITS | ids[b]) in self.rank:
                    heapq.heappush(heap, (self.rank[next_], a, next_))
        return [t for t in ids if t >= 0], made

    def _learn_tokens(self) -> None:
        """Of each token that merging yields: its length, the merge that makes it, its longest shorter prefix."""
        size = max(self.id_of.values()) + 1
        self.length = [0] * size
        self.left, self.right, self.taken = (array.array("q", [-1]) * size for _ in range(3))
        known: dict[str, int] = {}
        for text, token in self.id_of.items():
            ids, made = self.merge(text) if all(c in self.id_of for c in text) else ([], {})
            if ids == [token]:
                known[text] = token
                self.length[token] = len(text)
                if token in made:
                    self.left[token], self.right[token], self.taken[token] = made[token]
        self.automaton = ahocorasick.Automaton()
        self.shorter = array.array("q", [-1]) * size
        for text, token in known.items():
            self.automaton.add_word(text, (token, len(text) - 1))
            self.shorter[token] = next((known[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in known), -1)
        self.automaton.make_automaton()

    def _edge(self, token: int, child: array.array) -> list[tuple[int, int]]:
        """(node, rank of the merge that takes it up) from the outermost symbol up to the token."""
        found = [(token, NEVER)]
        while (below := child[token]) >= 0:
            found.append((below, self.taken[token]))
            token = below
        return found[::-1]

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging the symbols of both tokens leaves just these two.

        Goes up the right edge of one and the left edge of the other in the order of
        their merges, looking for a merge over the border that would come before the
        next one on either side. Of equal ranks the one further left comes first.
        """
        right, left = self._edge(first, self.right), self._edge(second, self.left)
        rank = self.rank
        i = j = 0
        fits = True
        while True:
            x, x_taken = right[i]
            y, y_taken = left[j]
            over = rank.get(x << PAIR_BITS | y)
            if over is not None and over < x_taken and over <= y_taken:
                fits = False
                break
            if x_taken == NEVER and y_taken == NEVER:
                break
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[first << PAIR_BITS | second] = fits
        return fits

    def encode_symbols(self, symbols: str) -> list[int]:
        """The tokens of one word."""
        whole = self.id_of.get(symbols)
        if whole is not None and self.length[whole]:
            return [whole]
        n = len(symbols)
        longest = [-1] * n
        for end, (token, more) in self.automaton.iter(symbols):
            longest[end - more] = token  # matches come by their end, so the last one is the longest
        open_ = bytearray(b"\x01") * (n + 1)
        tokens: list[int] = []
        length, pairs = self.length, self.pairs
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            if open_[end]:
                fits = not tokens or pairs.get(tokens[-1] << PAIR_BITS | token)
                if fits is None:
                    fits = self.compatible(tokens[-1], token)
                if fits:
                    tokens.append(token)
                    at = end
                    if at < n:
                        token = longest[at]
                    continue
            token = self.shorter[token]
            while token < 0:
                open_[at] = 0
                last = tokens.pop()
                at -= length[last]
                token = self.shorter[last]
        return tokens

    def word_ids(self, word: str) -> bytes:
        """The ids of one pre-token of normalised text, as little-endian 32-bit integers."""
        found = self.words.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                raw = word.encode("utf-8")
                symbols = raw[:-1].decode("latin-1").translate(self.characters) + self.last[raw[-1]]
                ids = array.array("I", self.encode_symbols(symbols))
                if sys.byteorder == "big":
                    ids.byteswap()
                found = ids.tobytes()
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= CACHED_WORDS // 2:
                    self.older, self.words = self.words, {}
                self.words[word] = found
        return found

    def _plain(self, text: str) -> bytes:
        if COMMON.fullmatch(text):
            return b"".join(map(self.word_ids, SPLIT.findall(text.lower())))
        normal = self.library.normalizer.normalize_str(text)
        parts = [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)] if normal else []
        return b"".join(map(self.word_ids, parts))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text; an added token's string becomes that token."""
        if self.special is None or not any(t in text for t in self.added):
            return self._plain(text)
        return b"".join(
            np.array([self.added[part]], "<u4").tobytes() if part in self.added else self._plain(part)
            for part in self.special.split(text)
        )

    def _offsets(self, names: dict[int, str]) -> None:
        """All tokens one after another, each behind a blank, and where each begins."""
        pieces = [(" " + names.get(i, "")).encode("utf-8") for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)

    def decode(self, ids: np.ndarray, at_once: int = 1 << 18) -> Iterator[bytes]:
        """The text of the ids in UTF-8, in pieces: the token names with blanks between them."""
        for i in range(0, len(ids), at_once):
            some = ids[i : i + at_once].astype(np.int64)
            begin = self.offsets[some]
            sizes = self.offsets[some + 1] - begin
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(begin - (ends - sizes), sizes)
            piece = self.blob[places].tobytes()
            yield piece[1:] if i == 0 else piece


@functools.lru_cache(maxsize=1)
def coder(path: str) -> WordBpe:
    """The tables of a file, once per worker."""
    return WordBpe(path)


@contextmanager
def _for_task(path: str) -> Iterator[WordBpe]:
    bpe = coder(path)
    try:
        yield bpe
    finally:
        bpe.forget()


def encode(text: Column, path: str) -> Column:
    """A text column's token ids as an array of integers; null counts as an empty text."""
    small_batches()

    @pandas_udf("array<int>")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with _for_task(path) as bpe:
            for batch in texts:
                ids = [np.frombuffer(bpe.encode(t or ""), "<u4").astype(np.int32) for t in batch]
                yield pd.Series(ids, dtype=object)

    return of_texts(text)


def decode(ids: Column, path: str) -> Column:
    """The text of an array of token ids; null and empty arrays give an empty text."""

    @pandas_udf("string")
    def of_ids(arrays: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = coder(path)
        for batch in arrays:
            yield pd.Series(
                ["" if a is None else b"".join(bpe.decode(np.asarray(a))).decode("utf-8") for a in batch], dtype=object
            )

    return of_ids(ids)


def round_trip(text: Column, path: str, with_ids: bool = False) -> Column:
    """(n_tokens, ids_sha256, decoded_sha256) of a text column, and the ids where they are asked for.

    Null counts as an empty text. Rows are independent: repeated rows and ids, other
    columns and empty tables need no care, and a very long text is decoded in pieces.
    """
    small_batches()
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    @pandas_udf(fields + ", ids array<int>" if with_ids else fields)
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 if with_ids else 3]
        with _for_task(path) as bpe:
            for batch in texts:
                rows, held = [], 0
                for t in batch:
                    raw = bpe.encode(t or "")
                    ids = np.frombuffer(raw, "<u4")
                    decoded = hashlib.sha256()
                    for piece in bpe.decode(ids):
                        decoded.update(piece)
                    row = (len(ids), hashlib.sha256(raw).hexdigest(), decoded.hexdigest())
                    rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                    held += len(ids) if with_ids else 0
                    if held >= IDS_AT_ONCE:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return of_texts(text)
