"""Fingerprints and groups beside a plain computation over all pairs."""

import random

import duckdb
import pytest
import xxhash

from stopgrid.llm import simhash
from stopgrid.llm.components import components
from stopgrid.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=4):
    """prints: (id, fingerprint) rows; the smallest id of each row's component."""
    distinct = sorted({fp for _, fp in prints})
    root = {fp: fp for fp in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for i, fp in prints:
        if i is not None:
            least[find(fp)] = min(i, least.get(find(fp), i))
    return [(i, fp, least.get(find(fp))) for i, fp in prints]


def unsigned(x):
    return x & (1 << 64) - 1


@pytest.mark.parametrize(
    "text", ["", "  \n\t", "one", "One two", "a b c d", "a b c d e", "É é\x0bx y A Z", "w " * 3000, " a b"]
)
def test_fingerprint(text):
    assert unsigned(simhash.fingerprint_of(text, 4)) == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(1000))
    whole = simhash.fingerprint_of(text, 4)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint_of(text, 4) == whole


def test_query_against_all_pairs(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    expected = sorted((i, f"{fp:016x}", c) for i, fp, c in plain_groups([(i, plain_fingerprint(t)) for i, t in rows]))
    assert sorted(map(tuple, QUERIES["op1_simhash_near_dedup"](spark, SF_DIR).collect())) == expected


@pytest.mark.parametrize("tile", [7, 16384])
def test_links_of_planted_chains(spark, monkeypatch, tile):
    """Chains, stars and random values, in one tile and in many."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(150)] + [0, (1 << 64) - 1]
    for base in prints[:6]:
        at = base
        for _ in range(15):
            for bit in rng.sample(range(64), rng.choice([1, 4, 5])):
                at ^= 1 << bit
            prints.append(at)
    prints += [prints[0] ^ 1 << b for b in range(64)]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4)
    assert edges.filter("bit_count(u ^ v) > 4").count() == 0
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    mine = [(p, roots.get(p, p)) for p in signed]
    expected = {p: c for p, (_, _, c) in zip(signed, plain_groups([(s, p) for s, p in zip(signed, prints)]))}
    assert {p: c for p, c in mine} == expected


def test_nulls_ties_and_repeats(make_docs):
    long = " ".join(f"w{i}" for i in range(5000))
    rows = [(4, "a b c d e"), (2, "A B  c d e"), (2, "A B  c d e"), (None, "a b c d e"), (7, None), (6, ""), (None, "only null"), (9, long), (8, long)]
    groups = simhash.near_duplicates(make_docs(rows))
    found = sorted(((r["id"], r["component_id"]) for r in groups.collect()), key=str)
    assert found == sorted([(4, 2), (2, 2), (2, 2), (None, 2), (7, 6), (6, 6), (None, None), (9, 8), (8, 8)], key=str)
    kept = simhash.keep_one(make_docs(rows))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([2, 2, 6, 8, None, None], key=str)


def test_empty_table_and_clashing_columns(make_docs, clash):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one(make_docs([])).count() == 0
    docs = clash([(1, "a b c d"), (2, "a b c d")], fp="x", id="y", keep_id="z", root="r", component_id="c")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (0, 1), (200, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
