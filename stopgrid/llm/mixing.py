"""Online logistic context mixing: how many bits a text takes, given what a corpus holds.

A text is its bytes, A-Z lower-cased, and an end. A byte is a path in a Huffman tree of
what follows the byte before it, so it is told in about three binary decisions. Several predictors guess each
decision, every one from a hash of its own context and the tree's node: the last four
bytes, the last six, the word so far. A slot of a predictor's table counts how often
the decision went either way in the learning texts; all of them are counted, by tasks of
their own and summed by blocks of slots.

While a text is scored, the guesses meet in the logistic domain, weighted. Some weights
always hold, others are added where the word so far is well known. After each decision
the weights in use take a step down the gradient of its cost, so they are refined as the
text goes on. They begin anew every `SEGMENT` bytes (contexts go on), so a text is scored
alike wherever it lies, and many segments advance side by side in numpy.

Beside the model stands a unigram of words with one added to each count. A task numbers
the words of a chunk of texts; the distinct words alone travel, to be summed over the
corpus and back to their chunks.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopgrid.llm.common import small_batches, text_of
from stopgrid.session import stored

#: Bytes between two beginnings of the weights.
SEGMENT = 1024
#: Segments that advance side by side, and steps laid out at once.
LANES = 8192
STEPS = 32
#: Bytes of text whose decisions are laid out at once, and whose segments advance together. In
#: longer texts contexts begin anew after the first of both.
LAID_OUT = 512 * SEGMENT
COUNTED_AT_ONCE = 4 * LAID_OUT
PART = 4096 * SEGMENT
#: Bounds of a table's slots, as powers of two; between them, by the bytes of the learning texts.
LEAST_BITS, MOST_BITS = 14, 21
#: Entries of the counts in a block that travels.
BLOCK = 1 << 16
#: Groups in which the blocks of the tasks are summed before they meet.
SPREAD = 64
#: Bytes of text of a chunk whose words are numbered together, and of all texts for each bucket of words.
CHUNK_BYTES = 16_000_000
BUCKET_BYTES = 16_000_000

END = 256
SYMBOLS = 257
#: The pair of no symbol.
GAP = 256 * SYMBOLS
#: Bytes before a text as contexts see them.
PAD = 8
#: Predictors by so many last bytes; one more goes by the word so far.
ORDERS = (4, 6)
PREDICTORS = len(ORDERS) + 1
#: What both counts of a slot have beforehand.
PRIOR = 0.4
#: A guess's steps in the logistic domain; in a code, the lowest bit says whether the slot is well known.
GUESS_STEP = 1 / 8
WELL_KNOWN = 30
FIRST_WEIGHT = (0.25, 0.5, 0.5, 0.1, 0.1, 0.85)
RATE = 0.03
#: No turn gets less than half of what this leaves of one.
SUREST = 0.9999

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANK = np.zeros(256, bool)
BLANK[[0, 9, 10, 11, 12, 13, 32]] = True
POWER = 0x9E3779B97F4A7C15
NODE_SPREAD = 0x9E3779B1


class Trees:
    """A Huffman tree of byte counts for each preceding byte: every symbol's path as nodes and turns."""

    def __init__(self, counts: np.ndarray):
        paths = [path for row in counts.reshape(256, SYMBOLS).tolist() for path in _paths(row)] + [[]]
        self.size = np.array(list(map(len, paths)), np.int32)
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int32)
        #: Node times two, plus the turn.
        self.steps = np.array(list(chain.from_iterable(paths)), np.uint16)

    def decisions(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node times two plus turn of every decision, how many each symbol takes); `pairs` has preceding bytes and symbols."""
        size = self.size[pairs]
        ends = np.cumsum(size, dtype=np.int32)
        where = np.repeat(self.begin[pairs] - (ends - size), size)
        where += np.arange(len(where), dtype=np.int32)
        return self.steps[where], size


def _paths(counts: list[int]) -> list[list[int]]:
    heap = [(c + 1, s, s) for s, c in enumerate(counts)]
    children: list[tuple[int, int]] = []
    heapq.heapify(heap)
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        children.append((left, right))
        heapq.heappush(heap, (a + b, len(counts) + len(children), -len(children)))
    paths: list[list[int]] = [[]] * len(counts)
    open_: list[tuple[int, list[int]]] = [(heap[0][2], [])]
    while open_:
        at, path = open_.pop()
        if at >= 0:
            paths[at] = path
        else:
            node = -at - 1
            open_ += [(child, [*path, node << 1 | turn]) for turn, child in enumerate(children[node])]
    return paths


class Contexts:
    """Parts of texts side by side, gaps between them: symbols, the bytes before each, and a hash of the word so far.

    Places in gaps have the pair `GAP`, which takes no decision.
    """

    def __init__(self, parts: list[tuple[bytes, bool]]):
        """`parts` are lower-cased bytes, and whether a text ends with them."""
        lengths = np.array([len(raw) for raw, _ in parts], np.int64)
        gap = b"\0" * PAD
        raw = np.frombuffer(gap + b"".join(chain.from_iterable((raw, gap) for raw, _ in parts)), np.uint8)
        n = len(raw) - PAD
        #: Places of each part and its gap.
        self.sizes = lengths + PAD
        ends = np.cumsum(self.sizes) - PAD
        self.pairs = raw[PAD - 1 : -1].astype(np.int32)
        self.pairs *= SYMBOLS
        self.pairs += raw[PAD:]
        told = np.array([end for _, end in parts])
        final = raw[PAD + ends - 1].astype(np.int32) * SYMBOLS + END
        for i in range(PAD):
            self.pairs[ends + i] = GAP
        self.pairs[ends[told]] = final[told]
        #: The last eight bytes, the last one on top.
        self.before = np.ndarray((n,), "<u8", raw, 0, (1,)).copy()
        blank = np.flatnonzero(BLANK[raw])
        begin = np.zeros(n + PAD, np.int32)
        begin[blank] = blank + 1
        np.maximum.accumulate(begin, out=begin)
        self.behind = np.arange(PAD, n + PAD, dtype=np.int32) - begin[PAD - 1 : -1]

    def word(self) -> np.ndarray:
        """Of each place a hash of the word so far: its last eight bytes, and how long it is."""
        with np.errstate(over="ignore"):
            half = (np.uint8(32) - np.uint8(4) * np.minimum(self.behind, PAD).astype(np.uint8)).astype(np.uint64)
            h = self.before >> half
            h >>= half
            h += self.behind.astype(np.uint64)
            return _spread(h)


def bytes_before(before: np.ndarray, n: int) -> np.ndarray:
    """A hash of the last `n` bytes."""
    return _spread((before >> np.uint64(64 - 8 * n)) + np.uint64(n << 56 | n))


def _spread(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h *= np.uint64(POWER)
        h ^= h >> np.uint64(32)
        h *= np.uint64(POWER)
        h >>= np.uint64(32)
        return h.astype(np.uint32)


def slots(hashes: np.ndarray, size: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """The slot of every decision in a table of two to the `bits`."""
    with np.errstate(over="ignore"):
        h = np.repeat(hashes, size)
        h += node
        h &= np.uint32((1 << bits) - 1)
        return h


def parts_of(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """A text in parts of bounded size, and whether it ends with each."""
    for i in range(0, max(len(text), 1), LAID_OUT):
        yield text[i : i + LAID_OUT], i + LAID_OUT >= len(text)


class Counts:
    """How often each slot's decision went either way, of all predictors."""

    def __init__(self, trees: Trees, bits: int):
        self.trees, self.bits = trees, bits
        self.table = np.zeros((PREDICTORS, 2 << bits), np.int32)

    def add(self, parts: list[tuple[bytes, bool]]) -> None:
        """Counts parts of texts; what stands often in the same context is counted once, with its weight."""
        if not parts:
            return
        texts = Contexts(parts)
        here = texts.pairs != GAP
        symbol = (texts.pairs % SYMBOLS)[here].astype(np.uint64)
        before = texts.before[here]
        most = 8 * max(ORDERS)
        found, times = np.unique((before >> np.uint64(64 - most)) << np.uint64(9) | symbol, return_counts=True)
        known = (found >> np.uint64(9)) << np.uint64(64 - most)
        self._add([(i, bytes_before(known, n)) for i, n in enumerate(ORDERS)], known, found, times)
        word = texts.word()[here].astype(np.uint64)
        found, times = np.unique(word << np.uint64(17) | (before >> np.uint64(56)) << np.uint64(9) | symbol, return_counts=True)
        known = (found >> np.uint64(9)) << np.uint64(56)
        self._add([(len(ORDERS), (found >> np.uint64(17)).astype(np.uint32))], known, found, times)

    def _add(self, hashes: list[tuple[int, np.ndarray]], before: np.ndarray, key: np.ndarray, times: np.ndarray) -> None:
        pairs = (before >> np.uint64(56)).astype(np.int32) * SYMBOLS + (key & np.uint64(511)).astype(np.int32)
        step, size = self.trees.decisions(pairs)
        node = (step >> 1).astype(np.uint32) * np.uint32(NODE_SPREAD)
        times = np.repeat(times.astype(np.float64), size)
        for which, hashed in hashes:
            where = slots(hashed, size, node, self.bits).astype(np.int64)
            where <<= 1
            where |= step & 1
            table = self.table[which]
            np.add(table, np.bincount(where, times, minlength=len(table)), out=table, casting="unsafe")


def codes_of(counts: np.ndarray) -> np.ndarray:
    """A guess for each pair of counts in one byte: the logistic value in steps, and whether it is well known."""
    no, yes = counts[0::2].astype(np.float32), counts[1::2].astype(np.float32)
    guess = np.log((yes + np.float32(PRIOR)) / (no + np.float32(PRIOR)))
    steps = np.clip(np.rint(guess / np.float32(GUESS_STEP)), -63, 63).astype(np.int8)
    return (steps << 1) | (no + yes >= WELL_KNOWN).astype(np.int8)


class Scorer:
    """Costs of texts under the tables of all predictors."""

    def __init__(self, trees: Trees, tables: list[np.ndarray]):
        self.trees, self.tables = trees, tables
        self.bits = len(tables[0]).bit_length() - 1

    def bits_of(self, texts: list[bytes]) -> np.ndarray:
        """The bits that each lower-cased text takes, its end included."""
        parts = [(i, *part) for i, text in enumerate(texts) for part in parts_of(text)]
        bits = np.zeros(len(texts))
        for some in _runs(parts, PART):
            # a part may be larger than what is laid out at once
            laid = [self._laid([(raw, ends) for _, raw, ends in few]) for few in _runs(some, LAID_OUT)]
            packed, n_steps = np.concatenate([x for x, _, _ in laid]), np.concatenate([x for _, x, _ in laid])
            per_part = np.concatenate([x for _, _, x in laid])
            owner = np.repeat([i for i, _, _ in some], per_part)
            bits += np.bincount(owner, self._mixed(packed, n_steps), minlength=len(texts))
        return bits / np.log(2)

    def _laid(self, parts: list[tuple[bytes, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All decisions in order, the guesses and the turn in four bytes each; decisions of each segment; segments of each part."""
        texts = Contexts(parts)
        step, per = self.trees.decisions(texts.pairs)
        node = (step >> 1).astype(np.uint32) * np.uint32(NODE_SPREAD)
        packed = np.empty((len(step), 4), np.int8)
        packed[:, PREDICTORS] = step & 1
        hashes = [bytes_before(texts.before, n) for n in ORDERS] + [texts.word()]
        for j, (table, h) in enumerate(zip(self.tables, hashes)):
            packed[:, j] = table.take(slots(h, per, node, self.bits))
        # a gap belongs to the segment before it
        pieces = np.maximum((texts.sizes - PAD + SEGMENT) // SEGMENT, 1)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(texts.sizes) - texts.sizes, pieces) + number * SEGMENT
        return packed.view("<i4").ravel(), np.add.reduceat(per, begin).astype(np.int64), pieces

    def _mixed(self, packed: np.ndarray, n_steps: np.ndarray) -> np.ndarray:
        """Cost of each segment in nats; those of about the same length go side by side."""
        start = np.cumsum(n_steps) - n_steps
        cost = np.empty(len(n_steps))
        order = np.argsort(-n_steps, kind="stable")
        for i in range(0, len(order), LANES):
            lanes = order[i : i + LANES]
            cost[lanes] = _mix(packed, start[lanes], n_steps[lanes])
        return cost


def _runs(parts: list[tuple], size: int) -> Iterator[list[tuple]]:
    """Parts in runs of about `size` bytes; the second of each is its bytes."""
    some, held = [], 0
    for part in parts:
        some.append(part)
        held += len(part[1]) + 1
        if held >= size:
            yield some
            some, held = [], 0
    if some:
        yield some


def _mix(packed: np.ndarray, start: np.ndarray, n_steps: np.ndarray) -> np.ndarray:
    """Cost of each lane in nats; lanes come by their steps, most first.

    Guesses are whole steps and turns are 1 or -1 here. The scale of both, and half the
    rate, are taken out of the weights: then a weight moves by error times guess.
    """
    lanes = len(start)
    scale = np.float32(RATE * GUESS_STEP**2 / 4)
    first = np.array(FIRST_WEIGHT, np.float32) * np.float32(GUESS_STEP / 2) / scale
    weights = np.repeat(first[:, None], lanes, axis=1)
    weights[PREDICTORS:] -= weights[:PREDICTORS]
    always, if_known = weights[:PREDICTORS], weights[PREDICTORS:]
    cost = np.zeros(lanes)
    active = np.searchsorted(-n_steps, -np.arange(n_steps[0]), side="left").tolist()
    product, change = (np.empty((PREDICTORS, lanes), np.float32) for _ in range(2))
    mixed, extra, so_far = (np.empty(lanes, np.float32) for _ in range(3))
    guess = np.empty((STEPS, PREDICTORS, lanes), np.float32)
    known, turn = (np.empty((STEPS, lanes), np.float32) for _ in range(2))
    one, sure = np.ones(1, np.float32), np.full(1, SUREST, np.float32)
    for t in range(0, len(active), STEPS):
        n, m = active[t], min(STEPS, len(active) - t)
        raw = packed.take(start[:n] + np.arange(t, t + m)[:, None], mode="clip")
        for i in range(PREDICTORS):
            guess[:m, i, :n] = (raw << (24 - 8 * i)) >> 25
        known[:m, :n] = (raw >> (8 * PREDICTORS - 8)) & 1
        turn[:m, :n] = ((raw >> 24) << 1) - 1
        so_far[:n] = 0
        for j in range(m):
            k = active[t + j]
            x, g, y = guess[j, :, :k], known[j, :k], turn[j, :k]
            a, b, p, c, d, e = always[:, :k], if_known[:, :k], product[:, :k], change[:, :k], mixed[:k], extra[:k]
            np.multiply(a, x, out=p)
            np.add.reduce(p, axis=0, out=d)
            np.multiply(b, x, out=p)
            np.add.reduce(p, axis=0, out=e)
            e *= g
            d += e
            d *= scale
            np.tanh(d, out=d)
            d *= sure
            np.subtract(y, d, out=e)
            np.multiply(x, e, out=c)
            a += c
            c *= g
            b += c
            # the turn taken has the share (1 + turn * mixed) / 2
            d *= y
            d += one
            np.log(d, out=d)
            so_far[:k] += d
        cost[:n] += so_far[:n]
    return n_steps * np.log(2) - cost


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bool], list[bytes]]]:
    """Ids, flags and lower-cased texts of about `PART` bytes."""
    ids, held, texts, size = [], [], [], 0
    for batch in batches:
        for id_, flag, raw in zip(*(batch.column(c) for c in ("id", "held_out")), batch.column("text").cast(pa.binary())):
            raw = raw.as_py().translate(LOWER)
            ids.append(id_.as_py())
            held.append(flag.as_py())
            texts.append(raw)
            size += len(raw) + 1
            if size >= PART:
                yield ids, held, texts
                ids, held, texts, size = [], [], [], 0
    if texts:
        yield ids, held, texts


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each symbol follows each byte in a task's texts."""
    total = np.zeros(256 * SYMBOLS, np.int64)
    for _, _, texts in _batched(batches):
        raw = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)
        pair = raw[:-1].astype(np.int32) * SYMBOLS
        gaps = np.cumsum([len(t) + 1 for t in texts]) - 1
        follower = raw[1:].astype(np.int32)
        follower[gaps] = END
        pair += follower
        total += np.bincount(pair, minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["pair", "n"])


COUNTED = "predictor int, block int, part long, bits binary, small binary, large binary"
#: Counts below it take a byte; what a larger one has above it is said beside.
SMALL = 255


def _block(predictor: int, block: int, part: int, counts: np.ndarray) -> pa.RecordBatch:
    """A block's counts: a bit for each that is not zero, these in a byte each, and the larger ones' rest with its place."""
    at = np.flatnonzero(counts)
    large = np.flatnonzero(counts > SMALL)
    rest = np.stack([large, counts[large] - SMALL]).astype("<i8")
    bits, small = np.packbits(counts > 0), np.minimum(counts[at], SMALL).astype(np.uint8)
    cells = (predictor, block, part, bits.tobytes(), small.tobytes(), rest.tobytes())
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([c], t) for c, t in zip(cells, kinds)], ["predictor", "block", "part", "bits", "small", "large"]
    )


def _add_block(total: np.ndarray, row: dict) -> None:
    held = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=len(total)).view(bool)
    total[held] += np.frombuffer(row["small"], np.uint8)
    at, rest = np.frombuffer(row["large"], "<i8").reshape(2, -1)
    total[at] += rest


def _counts(trees, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(trees.value, bits)
        for _, _, texts in _batched(batches):
            for some in _runs([(0, *part) for part in chain.from_iterable(map(parts_of, texts))], COUNTED_AT_ONCE):
                counts.add([(raw, ends) for _, raw, ends in some])
        group = TaskContext.get().partitionId() // SPREAD
        for predictor, table in enumerate(counts.table):
            for i in range(0, len(table), BLOCK):
                if table[i : i + BLOCK].any():
                    block = np.zeros(BLOCK, np.int64)
                    block[: len(table) - i] = table[i : i + BLOCK]
                    yield _block(predictor, i // BLOCK, group, block)

    return run


def _sums(last: bool):
    """Sums the rows of each block, which come together; at last the guesses take their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(BLOCK, np.int64)

        def told() -> pa.RecordBatch:
            if not last:
                return _block(*key, total)
            cells = (key[0], key[1], codes_of(total).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([c], t) for c, t in zip(cells, (pa.int32(), pa.int32(), pa.binary()))], ["predictor", "block", "codes"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["predictor"], row["block"], 0 if last else row["part"])
                if here != key:
                    if key is not None:
                        yield told()
                    key, total = here, np.zeros(BLOCK, np.int64)
                _add_block(total, row)
        if key is not None:
            yield told()

    return run


class Model:
    """Trees and tables of a corpus, sent once to each executor; their size has a fixed bound."""

    def __init__(self, spark: SparkSession, trees: Trees, tables: list[np.ndarray]):
        self.sent = spark.sparkContext.broadcast((trees, tables))

    def scorer(self) -> Scorer:
        return Scorer(*self.sent.value)


def _given(docs: DataFrame, id_col: str, text_col: str, held_out: Column | None) -> DataFrame:
    flag = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    return docs.select(F.col(f"`{id_col}`").alias("id"), flag.alias("held_out"), text_of(text_col).alias("text"))


def fit(
    docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS
) -> Model:
    """The model of all rows but those held out.

    The tables have as many slots as the texts have bytes, within bounds. Null texts
    are empty ones; without rows the model knows nothing and still scores.
    """
    small_batches()
    spark = docs.sparkSession
    learnt = _given(docs, id_col, text_col, held_out).where(~F.col("held_out"))
    pairs = learnt.mapInArrow(_pair_counts, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(256 * SYMBOLS, np.int64)
    for pair, n in pairs:
        seen[pair] = n
    bits = min(max(int(seen.sum()).bit_length(), LEAST_BITS), most_bits)
    trees = Trees(seen)
    sent = spark.sparkContext.broadcast(trees)
    blocks = learnt.mapInArrow(_counts(sent, bits), COUNTED)
    some = blocks.repartition("predictor", "block", "part").sortWithinPartitions("predictor", "block", "part").mapInArrow(_sums(False), COUNTED)
    sums = some.repartition("predictor", "block").sortWithinPartitions("predictor", "block")
    codes = sums.mapInArrow(_sums(True), "predictor int, block int, codes binary")
    tables = [np.zeros(1 << bits, np.int8) for _ in range(PREDICTORS)]
    for predictor, block, code in codes.collect():
        tables[predictor][block * BLOCK // 2 : (block + 1) * BLOCK // 2] = np.frombuffer(code, np.int8)[: len(tables[predictor])]
    sent.unpersist()
    return Model(spark, trees, tables)


def _row_schema(id_type: pa.DataType) -> pa.Schema:
    """A chunk's texts with their bits and words by number, bucket null; or its words of one bucket."""
    return pa.schema(
        [
            ("chunk", pa.int64()), ("bucket", pa.int32()), ("ids", pa.list_(id_type)), ("held", pa.list_(pa.bool_())),
            ("sizes", pa.list_(pa.int64())), ("bits", pa.list_(pa.float64())), ("n_words", pa.list_(pa.int64())),
            ("places", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
        ]
    )


def _rows_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class _Chunk:
    """Texts with their bits, and their words by number."""

    def __init__(self) -> None:
        self.ids, self.held, self.sizes, self.n_words, self.bits = [], [], [], [], []
        self.n_bytes = 0
        self.place_of: dict[bytes, int] = defaultdict()
        self.place_of.default_factory = self.place_of.__len__
        self.seen: list[np.ndarray] = []

    def add(self, ids: list, held: list[bool], texts: list[bytes], bits: np.ndarray) -> None:
        for text in texts:
            words = text.split()
            self.seen.append(np.fromiter(map(self.place_of.__getitem__, words), np.uint32, len(words)))
            self.n_words.append(len(words))
            self.n_bytes += len(text)
        self.ids += ids
        self.held += held
        self.sizes += map(len, texts)
        self.bits += bits.tolist()

    def rows(self, number: int, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The texts, and the words of each bucket with how often texts that are learnt from hold them.

        Words are numbered anew by bucket, so that the counts of all buckets, one after
        another, are those of the chunk's words.
        """
        words = list(self.place_of)
        bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        places = rank[np.concatenate(self.seen)] if words else np.zeros(0, np.uint32)
        learnt = np.bincount(places[np.repeat(~np.array(self.held), self.n_words)], minlength=len(words))
        texts = (number, None, self.ids, self.held, self.sizes, self.bits, self.n_words, places.astype("<u4").tobytes(), None, None)
        yield _rows_of(schema, [texts])
        used, begin = np.unique(bucket[order], return_index=True)
        rows = []
        for b, i, j in zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(words)]):
            some = b" ".join([words[k] for k in order[i:j].tolist()])
            rows.append((number, b, None, None, None, None, None, None, some, learnt[i:j].astype("<u4").tobytes()))
        if rows:
            yield _rows_of(schema, rows)


def _scored(model: Model, buckets: int, chunk_bytes: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, schema = model.scorer(), _row_schema(id_type)
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk()
        for ids, held, texts in _batched(batches):
            chunk.add(ids, held, texts, scorer.bits_of(texts))
            if chunk.n_bytes >= chunk_bytes:
                yield from chunk.rows(number, buckets, schema)
                number += 1
                chunk = _Chunk()
        if chunk.ids:
            yield from chunk.rows(number, buckets, schema)

    return run


ANSWERS = "chunk long, bucket int, counts binary, n_learnt long, n_distinct long"
ANSWER_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("n_learnt", pa.int64()), ("n_distinct", pa.int64())]
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the words of a bucket over all chunks and answers each chunk in the order it asked.

    The row without chunk has the bucket's learnt words, all and distinct.
    """
    bucket, asked = None, []

    def told() -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)
        for _, words, counts in asked:
            for word, n in zip(words.split(b" "), np.frombuffer(counts, "<u4").tolist()):
                total[word] += n
        for chunk, words, _ in asked:
            found = [total[word] for word in words.split(b" ")]
            yield _rows_of(ANSWER_SCHEMA, [(chunk, bucket, np.array(found, "<u8").tobytes(), None, None)])
        yield _rows_of(ANSWER_SCHEMA, [(None, bucket, None, sum(total.values()), sum(n > 0 for n in total.values()))])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("chunk", "bucket", "words", "counts")]
        for chunk, here, words, counts in zip(*columns):
            if here != bucket and asked:
                yield from told()
                asked = []
            bucket = here
            asked.append((chunk, words, counts))
    if asked:
        yield from told()


def _unigram(n_learnt: int, n_ends: int, n_distinct: int, id_type: pa.DataType):
    """The rows of each chunk, whose texts come first and then its words' counts by bucket."""
    schema = pa.schema(
        [("id", id_type), ("held_out", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("bits", pa.float64()), ("base_score", pa.float64())]
    )
    below = np.log10(n_learnt + n_distinct + 1)

    def told(row: dict, answers: list[bytes]) -> pa.RecordBatch:
        counts = np.frombuffer(b"".join(answers), "<u8")
        share = np.log10(counts + 1.0) - below
        n_words = np.array(row["n_words"], np.int64)
        places = np.frombuffer(row["places"], "<u4")
        owner = np.repeat(np.arange(len(n_words)), n_words)
        score = np.bincount(owner, share[places], minlength=len(n_words)) + (np.log10(n_ends + 1.0) - below)
        known = np.bincount(owner, counts[places] > 0, minlength=len(n_words)).astype(np.int64) + int(n_ends > 0)
        cells = (row["ids"], row["held"], row["sizes"], n_words + 1, known, row["bits"], score)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, answers = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if row["bucket"] is None:
                    if texts is not None:
                        yield told(texts, answers)
                    texts, answers = row, []
                else:
                    answers.append(row["counts"])
        if texts is not None:
            yield told(texts, answers)

    return run


def score(
    docs: DataFrame, model: Model, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(id, held_out, n_bytes, n_tokens, n_known, bits, base_score, train_tokens), a row for each row of `docs`.

    `bits` is what the model takes for the lower-cased text and its end. Tokens are words
    and one end; `base_score` sums the logarithms of their shares, one added to each
    count, in the tokens of the rows not held out, `train_tokens` in number; `n_known` of
    them occur there. Null texts are empty: an end alone. Each row is scored by itself,
    so rows may repeat and ids be null. Other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches()
    given = _given(docs, id_col, text_col, held_out)
    kind = given.schema["id"].dataType
    name, id_type = kind.simpleString(), to_arrow_type(kind)
    n_bytes, n_ends = given.agg(F.sum(F.octet_length("text").cast("long")), F.count_if(~F.col("held_out"))).first()
    buckets = (n_bytes or 0) // bucket_bytes + 1
    columns = (
        f"chunk long, bucket int, ids array<{name}>, held array<boolean>, sizes array<long>, bits array<double>, "
        "n_words array<long>, places binary, words binary, counts binary"
    )
    chunks = stored(given.mapInArrow(_scored(model, buckets, chunk_bytes, id_type), columns), "mixing-chunks")
    asked = chunks.where("bucket is not null").select("chunk", "bucket", "words", "counts")
    answers = stored(
        asked.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_counted, ANSWERS), "mixing-counts"
    )
    sums = answers.where("chunk is null").agg(F.sum("n_learnt"), F.sum("n_distinct")).first()
    n_learnt, n_distinct = (sums[0] or 0) + n_ends, (sums[1] or 0) + int(n_ends > 0)
    texts = chunks.where("bucket is null").select("chunk", "bucket", "ids", "held", "sizes", "bits", "n_words", "places")
    back = answers.where("chunk is not null").select("chunk", "bucket", "counts")
    return (
        texts.unionByName(back, allowMissingColumns=True)
        .repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_first("bucket"))
        .mapInArrow(
            _unigram(n_learnt, n_ends, n_distinct, id_type),
            f"id {name}, held_out boolean, n_bytes long, n_tokens long, n_known long, bits double, base_score double",
        )
        .withColumn("train_tokens", F.lit(n_learnt).cast("long"))
    )
