"""An FM-index over a bounded run of word ids, built and searched with numpy.

The text is an array of ids from 0 to `top`; 0 separates and matches nothing. Each
separator counts as a symbol of its own, ordered by place, so suffixes differ at the
next separator at the latest.
"""

from __future__ import annotations

import numpy as np

#: Places held by one index at most; sort keys keep this many bits for the place.
PLACE_BITS = 20
LIMIT = 1 << PLACE_BITS
SAMPLE_EVERY = 16


def suffix_array(text: np.ndarray, top: int) -> np.ndarray:
    """Places in the order of their suffixes, by sorting ever longer prefixes of what is not yet apart."""
    n = len(text)
    place = np.arange(n, dtype=np.uint64)
    bits = max(1, int(top).bit_length())
    width = max(1, (64 - PLACE_BITS) // bits)
    key = np.zeros(n, np.uint64)
    open_ = np.ones(n, bool)  # no separator met so far
    padded = np.concatenate([text, np.zeros(width, text.dtype)]).astype(np.uint64)
    for k in range(width):
        symbol = padded[k : k + n]
        key = (key << np.uint64(bits)) | np.where(open_, symbol, np.uint64(0))
        open_ &= symbol != 0
    # equal keys that have met a separator are in order by place already
    ordered = np.sort((key << np.uint64(PLACE_BITS)) | place)
    order = (ordered & np.uint64(LIMIT - 1)).astype(np.int64)
    prefix = ordered >> np.uint64(PLACE_BITS)
    head = np.ones(n, bool)
    head[1:] = (prefix[1:] != prefix[:-1]) | ~open_[order[1:]]
    rank = np.empty(n, np.int64)
    while True:
        rows = np.arange(n)
        group = np.maximum.accumulate(np.where(head, rows, 0))
        rank[order] = group
        last = np.append(head[1:], True)
        tied = np.flatnonzero(~(head & last))
        if not len(tied):
            return order
        places = order[tied]
        beyond = np.minimum(places + width, n - 1)
        key = (group[tied].astype(np.uint64) << np.uint64(2 * PLACE_BITS)) | (
            rank[beyond].astype(np.uint64) << np.uint64(PLACE_BITS)
        ) | places.astype(np.uint64)
        key.sort()
        order[tied] = (key & np.uint64(LIMIT - 1)).astype(np.int64)
        key >>= np.uint64(PLACE_BITS)
        head[tied] = np.append(True, key[1:] != key[:-1])
        width *= 2


class WaveletTree:
    """Ranks of symbols in prefixes of a sequence, one level of bits per bit of a symbol."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (sequence >> bit & 1).astype(bool)
            before = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(sequence) - int(before[-1])))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        begin, end = np.zeros_like(places), places
        for bit, before, zeros in self.levels:
            one = (symbols >> bit & 1).astype(bool)
            begin = np.where(one, zeros + before[begin], begin - before[begin])
            end = np.where(one, zeros + before[end], end - before[end])
        return end - begin


class FmIndex:
    def __init__(self, text: np.ndarray, top: int):
        if len(text) > LIMIT:
            raise ValueError(f"an index holds {LIMIT} places")
        order = suffix_array(text, top)
        before = np.concatenate([[0], text[:-1]]).astype(text.dtype) if len(text) else text
        self.last = before[order]  # the symbol before each suffix
        self.tree = WaveletTree(self.last, top)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        # places to count on from: every few, and those behind a separator, as walks end there
        sampled = (order % SAMPLE_EVERY == 0) | (self.last == 0)
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - sampled
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffixes that begin with each phrase.

        `phrases` has one phrase a row, without separators, padded with zeros behind
        its length. Backward search, all phrases at once.
        """
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        for back in range(1, phrases.shape[1] + 1 if len(phrases) else 0):
            live = np.flatnonzero((lengths >= back) & (high > low))
            symbols = phrases[live, lengths[live] - back].astype(np.int64)
            for ends in (low, high):
                ends[live] = self.smaller[symbols] + self.tree.rank(symbols, ends[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of rows, by stepping back to a sampled one."""
        found = np.empty(len(rows), np.int64)
        left, rows = np.arange(len(rows)), rows.astype(np.int64)
        steps = 0
        while len(left):
            here = self.sampled[rows]
            found[left[here]] = self.samples[self.sample_rank[rows[here]]] + steps
            left, rows = left[~here], rows[~here]
            symbols = self.last[rows].astype(np.int64)
            rows = self.smaller[symbols] + self.tree.rank(symbols, rows)
            steps += 1
        return found
