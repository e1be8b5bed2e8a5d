"""The pipeline over planted documents, beside the brute-force versions of its stages."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stopgrid.llm import decontaminate
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_simhash import plain_fingerprint, plain_groups

TOXIC = "vile nasty"


def text(rng, n):
    return " ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(60)}" for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Tables with toxic texts, copies, near copies, shared lines and benchmark passages."""
    rng = random.Random(11)
    passage = text(rng, 30)
    shared = text(rng, 60)
    docs = [(i, "\n".join(text(rng, 40) for _ in range(3))) for i in range(60)]
    docs += [(100 + i, f"{t} {TOXIC} {TOXIC}") for i, t in docs[:30]]
    docs += [(200 + i, t) for i, t in docs[:5]]
    docs += [(300 + i, t.replace(" ", " changed ", 1)) for i, t in docs[5:10]]
    docs += [(400 + i, f"{text(rng, 50)}\n{shared}\n{text(rng, 20)}") for i in range(6)]
    docs += [(500 + i, f"{text(rng, 30)} {passage} {text(rng, 30)}") for i in range(4)]
    docs += [(600, None), (601, ""), (602, "short"), (603, "short"), (604, "w " * 30_000)]
    base = f"{text(rng, 7)} " * 40
    docs += [(700 + i, base + f"end{i}") for i in range(3)]
    folder = tmp_path_factory.mktemp("planted")
    full = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in docs]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(TOXIC in (t or ""))) for i, t in docs if i < 60 or 100 <= i < 115]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, passage


def brute_force(docs, passage):
    rows = [(i, t) for i, t in docs if TOXIC not in (t or "")]
    dropped = {i: (n, left) for i, _, n, left in plain_lines(rows)}

    new = []
    for i, t in rows:
        n, left = dropped[i]
        if n and len(left.encode()) <= (1 - 0.8) * len(t.encode()):
            continue
        new.append((i, left if n else t))
    groups = plain_groups([(i, plain_fingerprint(t or "")) for i, t in new])
    stay = {i for i, _, least in groups if i == least}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = {}
    for i, t in new:
        if i in stay:
            hit = plain_hits(t, [(1, passage)], 10)[1]
            edges = [k for k in range(len(hit) + 1) if (k and hit[k - 1]) != (k < len(hit) and hit[k])]
            cut = decontaminate.without_spans(t, edges[::2], edges[1::2]) if any(hit) else t
            ids = library.encode(cut or "", add_special_tokens=False).ids
            raw = b"".join(k.to_bytes(4, "little") for k in ids)
            back = library.decode(ids, skip_special_tokens=False)
            out[i] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids)
    return out


def test_run(spark, planted):
    folder, docs, passage = planted
    rows = corpus_pipeline.run(spark, folder).collect()
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], list(r["ids"])) for r in rows}
    assert len(found) == len(rows)
    expected = brute_force(docs, passage)
    assert found == expected
    assert not set(found) & {*range(100, 130), *range(200, 210), *range(300, 310)}
    assert set(range(10, 60)) <= set(found) and {500, 501, 502, 503} <= set(found)


def test_stages_keep_columns(spark, planted):
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString()


def test_stages_on_an_empty_table(spark, planted):
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_operators_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "bpe",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
