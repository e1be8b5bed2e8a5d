"""Context mixing: trees, tables and mixing beside plain loops, the unigram beside a count by hand."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopgrid.llm import mixing as M


def lowered(text):
    return (text or "").encode().translate(M.LOWER)


def plain_trees(raws):
    pairs = np.zeros((256, M.SYMBOLS), np.int64)
    for raw in raws:
        for a, b in zip(b"\0" + raw, [*raw, M.END]):
            pairs[a, b] += 1
    return pairs, M.Trees(pairs.ravel())


def spread(h):
    h = h * M.POWER % 2**64
    h ^= h >> 32
    return (h * M.POWER % 2**64) >> 32


def plain_hashes(raw, i):
    """The contexts of a place, byte by byte."""
    behind = (b"\0" * M.PAD + raw[:i])[-M.PAD :]
    found = [spread((int.from_bytes(behind[-n:], "little") + (n << 56 | n)) % 2**64) for n in M.ORDERS]
    blanks = bytes(np.flatnonzero(M.BLANK).tolist())
    word = raw[:i][max(raw[:i].rfind(bytes([b])) for b in blanks) + 1 :]
    return [*found, spread((int.from_bytes(word[-8:], "little") + len(word)) % 2**64)]


def plain_steps(trees, raw, bits):
    """(slots of the predictors, turn) of each decision."""
    for i, symbol in enumerate([*raw, M.END]):
        pair = (raw[i - 1] if i else 0) * M.SYMBOLS + symbol
        for step in trees.steps[trees.begin[pair] : trees.begin[pair] + trees.size[pair]].tolist():
            yield [(h + (step >> 1) * M.NODE_SPREAD) % 2**32 % 2**bits for h in plain_hashes(raw, i)], step & 1


def plain_counts(trees, raws, bits):
    counts = np.zeros((M.PREDICTORS, 2 << bits), np.int64)
    for raw in raws:
        for slots, turn in plain_steps(trees, raw, bits):
            for p, s in enumerate(slots):
                counts[p, 2 * s + turn] += 1
    return counts


def plain_bits(trees, tables, raw, bits):
    """The mixing in a loop, a decision at a time, in double precision."""
    total, n = 0.0, -1
    by_symbol = []
    for i, symbol in enumerate([*raw, M.END]):
        pair = (raw[i - 1] if i else 0) * M.SYMBOLS + symbol
        by_symbol += [i] * int(trees.size[pair])
    for (slots, turn), i in zip(plain_steps(trees, raw, bits), by_symbol):
        if i // M.SEGMENT != n:
            n = i // M.SEGMENT
            always = list(map(float, M.FIRST_WEIGHT[: M.PREDICTORS]))
            if_known = [b - a for a, b in zip(always, M.FIRST_WEIGHT[M.PREDICTORS :])]
        codes = [int(t[s]) for t, s in zip(tables, slots)]
        known = codes[-1] & 1
        guess = [(c >> 1) * M.GUESS_STEP for c in codes]
        mixed = sum((a + known * b) * g for a, b, g in zip(always, if_known, guess))
        sure = math.tanh(mixed / 2) * M.SUREST
        way = 2 * turn - 1
        for j, g in enumerate(guess):
            step = M.RATE * (way - sure) / 2 * g
            always[j] += step
            if_known[j] += known * step
        total -= math.log2((1 + way * sure) / 2)
    return total


TEXTS = ["the cat sat on the mat.\n", "The CAT\tsat", "", "a", "zzz \x00 é日本", "on the mat on the mat on the mat " * 60, "extraordinarily longwords\x00here"]


def test_trees_are_prefix_codes():
    _, trees = plain_trees([lowered(t) for t in TEXTS])
    for before in (0, 32, 97, 200):
        paths = []
        for s in range(M.SYMBOLS):
            i = before * M.SYMBOLS + s
            paths.append(tuple(trees.steps[trees.begin[i] : trees.begin[i] + trees.size[i]].tolist()))
        assert len(set(paths)) == M.SYMBOLS
        assert sum(2.0 ** -len(p) for p in paths) == 1.0


def test_counts_beside_a_loop():
    raws = [lowered(t) for t in TEXTS]
    _, trees = plain_trees(raws)
    counts = M.Counts(trees, 12)
    counts.add([p for r in raws for p in M.parts_of(r)])
    assert (counts.table == plain_counts(trees, raws, 12)).all()


def test_bits_beside_a_loop(monkeypatch):
    monkeypatch.setattr(M, "SEGMENT", 100)
    raws = [lowered(t) for t in TEXTS]
    _, trees = plain_trees(raws[:4])
    tables = [M.codes_of(c) for c in plain_counts(trees, raws[:4], 12)]
    found = M.Scorer(trees, tables).bits_of(raws)
    for raw, bits in zip(raws, found):
        assert bits == pytest.approx(plain_bits(trees, tables, raw, 12), rel=1e-3, abs=1e-3)


def test_probabilities_sum_to_one():
    """Of all one-byte texts and what begins with them: the first symbol's shares."""
    raws = [lowered(t) for t in TEXTS]
    _, trees = plain_trees(raws)
    scorer = M.Scorer(trees, [M.codes_of(c) for c in plain_counts(trees, raws, 12)])
    rng = random.Random(2)
    parts = [(bytes([b]), False) for b in range(256)] + [(b"", True)]
    rng.shuffle(parts)
    packed, n_steps, _ = scorer._laid(parts)
    assert np.exp(-scorer._mixed(packed, n_steps)).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_neighbours(monkeypatch):
    raws = [lowered(t) for t in TEXTS]
    _, trees = plain_trees(raws)
    scorer = M.Scorer(trees, [M.codes_of(c) for c in plain_counts(trees, raws, 12)])
    together, alone = scorer.bits_of(raws), [scorer.bits_of([r])[0] for r in raws]
    monkeypatch.setattr(M, "LANES", 2)
    monkeypatch.setattr(M, "STEPS", 3)
    assert together == pytest.approx(alone, rel=1e-5) and scorer.bits_of(raws) == pytest.approx(alone, rel=1e-5)
    assert scorer.bits_of([]).tolist() == []


def held(column="doc_id"):
    return F.pmod(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")), F.lit(7)) == 2


def test_tables_of_a_fit_beside_a_loop(spark, make_docs):
    docs = make_docs(list(enumerate(TEXTS)) * 3).repartition(5)
    model = M.fit(docs, most_bits=12)
    raws = [lowered(t) for t in TEXTS] * 3
    pairs, trees = plain_trees(raws)
    sent, tables = model.sent.value
    assert (sent.steps == trees.steps).all()
    bits = len(tables[0]).bit_length() - 1
    for table, counts in zip(tables, plain_counts(trees, raws, bits)):
        assert (table == M.codes_of(counts)).all()


@pytest.mark.parametrize("chunk_bytes", [300, M.CHUNK_BYTES])
def test_scores_of_rows(spark, make_docs, clash, chunk_bytes):
    """The unigram by hand; nulls, empty and long texts, repeated rows, null ids."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["Alpha", "beta", "Gamma,", "δ"], k=rng.randint(0, 40)))) for i in range(60)]
    rows += [(None, None), (None, "beta new"), (3, ""), (3, ""), (100, "long " * 3000)]
    docs = make_docs(rows).repartition(3)
    flags = {r[0]: bool(r[1]) for r in docs.select("doc_id", held()).collect()}
    assert any(flags.values())
    counts, n = Counter(), 0
    for i, t in rows:
        if not flags[i]:
            words = [*lowered(t).split(), None]
            counts.update(words)
            n += len(words)
    found = M.score(docs, M.fit(docs, held()), held(), chunk_bytes=chunk_bytes, bucket_bytes=chunk_bytes).collect()
    expected = []
    for i, t in rows:
        words = [*lowered(t).split(), None]
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words)
        expected.append((i, flags[i], len(lowered(t)), len(words), sum(counts[w] > 0 for w in words), round(base, 9), n))
    names = ["id", "held_out", "n_bytes", "n_tokens", "n_known"]
    assert sorted(((*[r[c] for c in names], round(r["base_score"], 9), r["train_tokens"]) for r in found), key=str) == sorted(expected, key=str)
    same = {}
    for r in found:
        assert same.setdefault((r["id"], r["n_bytes"], r["n_tokens"]), r["bits"]) > 0
    odd = clash([(1, "some text")], words="w", chunk="c", n="n", bits="b", at="a", learnt="l", held_out="h")
    assert M.score(odd, M.fit(odd)).count() == 1


def test_nothing(spark, make_docs):
    docs = make_docs([])
    assert M.score(docs, M.fit(docs)).count() == 0
    alone = make_docs([(1, "unseen words"), (2, None)])
    rows = M.score(alone, M.fit(docs), F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}


def test_it_learns(spark):
    """Texts like the learnt ones take fewer bits than others of the same length, and held-out ones little."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = M.fit(docs, held())
    noise = docs.where(held()).selectExpr("doc_id", "reverse(text) as text")
    own = M.score(docs.where(held()), model).agg(F.sum("bits"), F.sum("n_bytes")).first()
    backwards = M.score(noise, model).agg(F.sum("bits"), F.sum("n_bytes")).first()
    assert own[0] / own[1] < 3 < backwards[0] / backwards[1]
