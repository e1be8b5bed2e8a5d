"""Token counts, encoding and decoding beside the library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stopgrid.llm import bpe, token_counts
from stopgrid.llm.queries import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"
TRICKY = [
    "", " ", "\n\n \t", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|endoftext", "ΑΣ Σ ΌΔΟΣ", "İstanbul ﬁ ǅ",
    "a\x1cb\x85c d e　f", "é Å ́é", "한국어 日本語 123 ½²", "'S don't I'LL we've 'tis", "x" * 3000,
    "aaaa" * 500, "ab" * 700, "to " * 1000, "\x00\x01\x7f", "😀 👩‍👩‍👧", "Ⅷ ⅷ ٣", "a  b   c \n d", "naïve—“quoted” … ×÷",
]


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(WORDS)


def ids(coder, text):
    return np.frombuffer(coder.encode(text), "<u4").tolist()


@pytest.mark.parametrize("text", TRICKY)
def test_encoding_and_decoding_of_tricky_texts(coder, text):
    expected = coder.library.encode(text, add_special_tokens=False).ids
    assert ids(coder, text) == expected
    decoded = b"".join(coder.decode(np.array(expected, "<u4"))).decode()
    assert decoded == coder.library.decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("abeinst'é 1.,\n", max_size=120)))
def test_encoding_of_any_text(coder, text):
    assert ids(coder, text) == coder.library.encode(text, add_special_tokens=False).ids


def test_compatibility_is_what_merging_says(coder):
    """The pair table beside merging the symbols of both tokens."""
    rng = random.Random(1)
    text_of = {i: t for t, i in coder.id_of.items()}
    tokens = [t for t in coder.length if t < 3000 and not text_of[t].endswith(tuple(map(chr, range(bpe.END, bpe.END + 400))))]
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert coder.compatible(a, b) == (coder.merge(text_of[a] + text_of[b])[0] == [a, b])


def test_decoding_in_pieces(coder):
    some = np.array(ids(coder, "the quick brown fox jumps over the lazy dog " * 5), "<u4")
    assert b"".join(coder.decode(some, 3)) == b"".join(coder.decode(some))
    assert b"".join(coder.decode(np.zeros(0, "<u4"))) == b""


def test_columns(spark, make_docs):
    docs = make_docs(list(enumerate(TRICKY)) + [(None, None), (3, "again"), (3, "again")])
    found = docs.select("text", bpe.encode(F.col("text"), WORDS).alias("ids")).select("*", bpe.decode(F.col("ids"), WORDS).alias("back"))
    library = Tokenizer.from_file(WORDS)
    for text, tokens, back in found.collect():
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert list(tokens) == expected and back == library.decode(expected, skip_special_tokens=False)
    assert docs.limit(0).select(bpe.round_trip(F.col("text"), WORDS).alias("r")).count() == 0


def test_round_trip_query(spark):
    library = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe_round_trip"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for doc_id, n, ids_sha256, decoded_sha256 in rows:
        tokens = library.encode(texts[doc_id], add_special_tokens=False).ids
        raw = b"".join(t.to_bytes(4, "little") for t in tokens)
        back = library.decode(tokens, skip_special_tokens=False)
        assert (n, ids_sha256) == (len(tokens), hashlib.sha256(raw).hexdigest())
        assert decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def counted(docs, **more):
    rows = token_counts.token_counts(docs, BYTES, **more).collect()
    return sorted(((r["id"], r["n_bytes"], r["n_tokens"]) for r in rows), key=str)


def expected_counts(rows):
    library = Tokenizer.from_file(BYTES)
    texts = [(i, t or "") for i, t in rows]
    return sorted(((i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts), key=str)


@pytest.mark.parametrize("chunk", [30, 16_000_000])
def test_counts(make_docs, chunk):
    rows = list(enumerate(TRICKY)) + [(None, None), (None, "x y"), (3, "again"), (3, "again"), (4, "again"), (3, "other")]
    assert counted(make_docs(rows), chunk_chars=chunk) == expected_counts(rows)


@pytest.mark.parametrize("buckets", [1, 7, 100_000])
def test_counts_by_any_number_of_buckets(make_docs, buckets):
    rows = list(enumerate(TRICKY))
    assert counted(make_docs(rows), chunk_chars=300, buckets=buckets) == expected_counts(rows)


def test_counts_of_nothing_and_of_clashing_columns(make_docs, clash):
    assert counted(make_docs([])) == []
    assert counted(make_docs([(1, ""), (2, None)])) == [(1, 0, 0), (2, 0, 0)]
    docs = clash([(1, "some text")], token="t", key="k", chunk="c", id="i", pieces="p")
    assert counted(docs) == expected_counts([(1, "some text")])


def test_count_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op2_token_counts"](spark, SF_DIR).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows), key=str) == expected_counts(texts)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
