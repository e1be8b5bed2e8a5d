"""The ordinal model beside its likelihood, and on labelled documents it has not seen."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopgrid.llm import toxicity

SF_DIR = "/root/testdata/sf0.1"


def likelihood(x, grade, weights, thresholds):
    score = x @ weights
    above = 1 / (1 + np.exp(-(score[:, None] - thresholds)))
    above = np.hstack([np.ones((len(x), 1)), above, np.zeros((len(x), 1))])
    rows = np.arange(len(x))
    return np.log(above[rows, grade] - above[rows, grade + 1]).mean() - toxicity.PENALTY * (weights**2).sum() / 2


def test_fit_is_a_maximum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    truth = np.array([1.5, -1.0, 0.0])
    noise = rng.logistic(size=400)
    grade = np.searchsorted([-1.0, 0.5, 2.0], x @ truth + noise)
    row, bucket = np.divmod(np.arange(x.size), 3)
    old, toxicity.STEPS = toxicity.STEPS, 3000
    try:
        weights, thresholds = toxicity.fit_ordinal(row, bucket, x.ravel(), grade, 3)
    finally:
        toxicity.STEPS = old
    assert (np.diff(thresholds) > 0).all() and np.abs(weights - truth).max() < 0.4
    best = likelihood(x, grade, weights, thresholds)
    for k in range(3):
        for step in (-0.05, 0.05):
            moved = np.eye(3)[k] * step
            assert likelihood(x, grade, weights + moved, thresholds) < best + 1e-4
            assert likelihood(x, grade, weights, thresholds + moved) < best + 1e-4


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_held_out_documents(spark, tables):
    docs, labels = tables
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)) == 0
    model = toxicity.fit(docs, labels.filter(~fold))
    known = labels.filter(fold).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, model).join(known, "doc_id").collect()
    rows = [(r["severity"], r["grade"], r["label"]) for r in scored]
    toxic = [s >= toxicity.CUT for s, _, label in rows if label]
    clean = [s >= toxicity.CUT for s, _, label in rows if not label]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.005
    assert {g for _, g, _ in rows} <= set(range(toxicity.GRADES + 1)) and all(0 <= s <= toxicity.GRADES for s, _, _ in rows)


def test_same_rows_same_model(spark, tables):
    docs, labels = (t.filter("doc_id < 600") for t in tables)
    a = toxicity.fit(docs, labels, 100)
    b = toxicity.fit(docs.repartition(3, "lang"), labels.repartition(2), 100)
    assert np.array_equal(a.buckets, b.buckets) and np.allclose(a.weights, b.weights) and np.allclose(a.thresholds, b.thresholds)


def test_odd_rows(spark, make_docs, clash):
    texts = [(i, f"plain words number {i} " + ("vile nasty " * (1 + i % 3) if i % 2 else "good fine ")) for i in range(60)]
    rows = [*texts, (60, None), (61, ""), (None, "vile nasty vile"), (62, "vile " * 50_000), (3, texts[3][1])]
    labels = [(i, 1, i % 2) for i in range(60)] + [(3, 1, 0), (None, 1, 1), (5, None, None), (999, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(make_docs(rows), labels)
    scored = toxicity.score(make_docs(rows), model).collect()
    assert len(scored) == len(rows)
    assert {r["doc_id"] for r in scored if r["toxic"]} == {*range(1, 60, 2), None, 62}
    kept = toxicity.keep_clean(clash(rows, severity="s", severity_of_text="t", toxic="x"), model)
    assert kept.columns[-3:] == ["severity", "severity_of_text", "toxic"]
    assert {r["doc_id"] for r in kept.collect()} == {*range(0, 60, 2), 60, 61}


def test_no_examples(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "some text"), (2, None)])
    for labels in (none, clean):
        rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert [(r["severity"], r["toxic"]) for r in rows] == [(0.0, False)] * 2
    empty = make_docs([])
    assert toxicity.score(empty, toxicity.fit(empty, clean)).count() == 0


def test_an_id_counts_once_however_many_rows_it_has(make_docs, spark, monkeypatch):
    """The sample is bounded in rows, not in ids alone."""
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices(["calm", "bread", "river", "stone"], k=20)) + (" vile scum" if i % 3 == 0 else "")) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    once = toxicity.fit(make_docs(docs), labels)
    seen = []
    real = toxicity.fit_sample
    monkeypatch.setattr(toxicity, "fit_sample", lambda toxic, *more: seen.append(len(toxic)) or real(toxic, *more))
    hot = toxicity.fit(make_docs(docs + [docs[0]] * 500), labels)
    assert seen == [90]
    assert (once.buckets == hot.buckets).all() and (once.weights == hot.weights).all() and (once.thresholds == hot.thresholds).all()


def test_severity_beside_a_loop(make_docs):
    """Every word's buckets added up, a document's score, and the thresholds it passes."""
    rng = random.Random(3)
    words = ["vile", "scum", "bread", "river", "ünder", "a", "Stone"]
    buckets = np.unique([b for w in words for b in toxicity.features_of(w.lower().encode())])
    model = toxicity.Model(buckets, np.array([rng.uniform(-1, 2) for _ in buckets], np.float32), np.array([0.2, 0.9, 1.7]))
    worth = dict(zip(buckets.tolist(), model.weights.tolist()))
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(60)] + [(90, None), (91, "?!")]
    found = {r["doc_id"]: r["severity"] for r in toxicity.score(make_docs(docs), model).collect()}
    for i, text in docs:
        counts = toxicity.weighed(text or "")
        expected = 0.0
        if counts:
            total = sum(n * sum(worth.get(b, 0.0) for b in np.asarray(toxicity.features_of(w)).tolist()) for w, n in counts.items())
            score = total / math.sqrt(sum(counts.values()))
            expected = sum(1 / (1 + math.exp(-(score - t))) for t in model.thresholds)
        assert found[i] == pytest.approx(expected, abs=1e-5), (i, text)
