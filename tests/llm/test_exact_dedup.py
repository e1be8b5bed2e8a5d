"""Exact duplicates beside a dictionary, for every split into frequent and rare texts."""

import hashlib

import pytest

from stopgrid.llm import exact_dedup


def plain(rows):
    def lowered(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")

    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[lowered(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = (
    [(i, "Frequent Text") for i in range(60)]
    + [(i, "other ÉTÉ") for i in range(60, 70)]
    + [(70, "other été"), (71, None), (72, ""), (None, "Frequent text"), (None, "alone"), (None, "ALONE")]
    + [(80, "x" * 200_000), (81, "X" * 200_000), (82, "rare"), (82, "rare"), (83, " rare")]
)


@pytest.mark.parametrize("share", [0.5, 0.1, 0.002])
def test_marks(make_docs, share):
    assert sorted(map(tuple, exact_dedup.mark(make_docs(ROWS), share).collect()), key=str) == plain(ROWS)


def test_frequent_digests_are_split_off(make_docs):
    heavy = exact_dedup.heavy_hitters(exact_dedup.digests(make_docs(ROWS)), 0.3).collect()
    assert {(r["keep_id"], r["group_size"]) for r in heavy} >= {(59, 61)}


def test_kept_rows(make_docs, clash):
    kept = exact_dedup.keep_largest(make_docs(ROWS))
    expected = [i for i, keep, _, stays, _ in plain(ROWS) if stays]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(expected, key=str)
    docs = clash([(1, "a"), (2, "A")], digest="d", keep_id="k", id="i", kept_id="x")
    kept = exact_dedup.keep_largest(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_empty_table(make_docs):
    assert exact_dedup.mark(make_docs([])).count() == 0
    assert exact_dedup.keep_largest(make_docs([])).count() == 0
