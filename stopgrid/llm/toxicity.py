"""Toxicity by cumulative-link ordinal regression over sparse text features.

Severity has grades from 0 (clean) to 3. One weight vector serves all grades; ordered
thresholds t1 < t2 < t3 turn a score s into P(grade >= k) = sigmoid(s - tk), and the
sum of these is the expected severity. Labels only say toxic or not, so the toxic
examples are split in thirds by how densely marking features stand in them.

Features are a word's hash and those of its beginnings and ends. A word that stands n
times counts 1 + log n, over the square root of the sum of a text's counts, and
features are scaled by their log ratio between toxic and clean examples. The model is fitted on a bounded sample of labelled rows; scoring reads all
texts whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from stopgrid.llm.common import free_name, small_batches, text_of

#: Labelled rows the model is fitted on at most, picked by a hash of their id.
SAMPLE_ROWS = 5000
GRADES = 3
#: A document of at least this expected severity is rejected.
CUT = 0.15
BUCKETS = 1 << 21
AFFIXES = (4, 5, 6)
MIN_DOCS = 4
MIN_RATIO = 0.5
STEPS = 150
RATE = 0.05
PENALTY = 1e-4
CACHED_WORDS = 200_000

_word = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return _word.findall(text.lower().encode("utf-8", "surrogatepass"))


def features_of(word: bytes) -> list[int]:
    """The buckets of a word: itself, its beginnings and its ends."""
    parts = [b"=" + word, *(b"<" + word[:n] for n in AFFIXES), *(b">" + word[-n:] for n in AFFIXES)]
    return [zlib.crc32(p) % BUCKETS for p in parts]


def weighed(text: str) -> dict[bytes, float]:
    """The distinct words of a text, and what each counts."""
    return {w: 1.0 if n == 1 else 1 + math.log(n) for w, n in Counter(words_of(text)).items()}


@dataclass
class Model:
    """Weights of the buckets that matter, and the thresholds. Without thresholds nothing is toxic."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def dense(self) -> np.ndarray:
        found = np.zeros(BUCKETS, np.float32)
        found[self.buckets] = self.weights
        return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(
    row: np.ndarray, bucket: np.ndarray, value: np.ndarray, grade: np.ndarray, n_buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the most likely proportional-odds model, by Adam over all rows.

    The entries (row, bucket, value) are sorted by row. The thresholds are kept in
    order by fitting the first and the logarithms of the steps between them.
    """
    n, top = len(grade), int(grade.max())
    weights, steps = np.zeros(n_buckets), np.zeros(top)
    share = np.array([(grade >= k).mean() for k in range(1, top + 1)])
    level = np.log((1 - share) / share)
    steps[0] = level[0]
    steps[1:] = np.log(np.maximum(np.diff(level), 1e-2))
    mean = [np.zeros_like(weights), np.zeros_like(steps)]
    square = [np.zeros_like(weights), np.zeros_like(steps)]
    rows = np.arange(n)
    for turn in range(1, STEPS + 1):
        thresholds = steps[0] + np.concatenate([[0], np.cumsum(np.exp(steps[1:]))])
        score = np.bincount(row, value * weights[bucket], n)
        above = np.ones((n, top + 2))
        above[:, 1:-1] = _sigmoid(score[:, None] - thresholds)
        above[:, -1] = 0
        low, high = above[rows, grade], above[rows, grade + 1]
        chance = np.maximum(low - high, 1e-9)
        by_score = (low + high - 1) / n  # of the negative log likelihood
        by_threshold = np.zeros(top + 2)
        np.add.at(by_threshold, grade, low * (1 - low) / chance / n)
        np.add.at(by_threshold, grade + 1, -high * (1 - high) / chance / n)
        below = np.cumsum(by_threshold[1:-1][::-1])[::-1]
        slopes = [
            np.bincount(bucket, value * by_score[row], n_buckets) + PENALTY * weights,
            np.concatenate([below[:1], below[1:] * np.exp(steps[1:])]),
        ]
        for at, slope, m, s in zip((weights, steps), slopes, mean, square):
            m += 0.1 * (slope - m)
            s += 0.001 * (slope * slope - s)
            at -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.999**turn)) + 1e-8)
    return weights, steps[0] + np.concatenate([[0], np.cumsum(np.exp(steps[1:]))])


def fit_sample(toxic: np.ndarray, buckets: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """The model of a sample: per row whether it is toxic, and its buckets with frequencies.

    Buckets in few rows, and those about as common in toxic rows as in others, are left
    out. The log ratios lean on the share of toxic rows, so that a rare bucket says little.
    """
    none = Model(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0))
    n_toxic, n = int(toxic.sum()), len(toxic)
    if n_toxic in (0, n):
        return none
    bad = np.bincount(np.concatenate([b for b, t in zip(buckets, toxic) if t]), minlength=BUCKETS)
    seen = bad + np.bincount(np.concatenate([b for b, t in zip(buckets, toxic) if not t]), minlength=BUCKETS)
    share = n_toxic / n
    used = np.flatnonzero(seen >= min(MIN_DOCS, n_toxic))
    bad, seen = bad[used], seen[used]
    in_toxic, in_clean = (bad + 2 * share) / (n_toxic + 2), (seen - bad + 2 * (1 - share)) / (n - n_toxic + 2)
    ratio = np.log(in_toxic / in_clean)
    telling = np.abs(ratio) >= MIN_RATIO
    used, ratio = used[telling], ratio[telling]
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    rows, places, values = [], [], []
    for i, (b, c) in enumerate(zip(buckets, counts)):
        at = place[b]
        kept = at >= 0
        at = at[kept]
        length = max(1.0, float(c.sum()) / (1 + 2 * len(AFFIXES)))
        rows.append(np.full(len(at), i, np.int32))
        places.append(at)
        values.append((c[kept] * np.abs(ratio[at]) / length**0.5).astype(np.float32))
    row, at, value = np.concatenate(rows), np.concatenate(places), np.concatenate(values)
    if not len(at):
        return none
    marks = np.bincount(row, value * (ratio[at] > 1), n)
    ladder = np.quantile(marks[toxic], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic, 1 + np.searchsorted(ladder, marks, "right"), 0)
    _, grade = np.unique(grade, return_inverse=True)  # grades nobody has are left out
    weights, thresholds = fit_ordinal(row, at, value, grade, len(used))
    return Model(used, (weights * np.abs(ratio)).astype(np.float32), thresholds)


def _count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for toxic, text in zip(batch["toxic"], batch["text"]):
            found: dict[int, float] = defaultdict(float)
            for word, n in weighed(text).items():
                for f in features_of(word):
                    found[f] += n
            buckets = np.array(sorted(found), "<i4")
            counts = np.array([found[b] for b in buckets.tolist()], "<f4")
            rows.append((toxic, buckets.tobytes(), counts.tobytes()))
        yield pd.DataFrame(rows, columns=["toxic", "buckets", "counts"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most `sample_rows` labelled documents, the same for the same rows.

    Rows of `labels` without id or label are ignored, and a document counts as toxic
    if one of its rows says so. Of several documents with one id that with the smallest
    hash of its text counts. Labels of one kind only, or none, give a model that
    finds nothing toxic.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    picked = (
        known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    texts = docs.select(F.col("doc_id").alias("id"), text_of().alias("text"))
    # a broadcast of sample_rows ids at most; of an id's rows one, however many it has
    rows = texts.join(F.broadcast(picked), "id").groupBy("id").agg(
        F.max("toxic").alias("toxic"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    )
    rows = rows.select("toxic", "text")
    small_batches()
    counted = rows.mapInPandas(_count_features, "toxic int, buckets binary, counts binary")
    sample = sorted((toxic > 0, bytes(buckets), bytes(counts)) for toxic, buckets, counts in counted.collect())
    return fit_sample(
        np.array([toxic for toxic, _, _ in sample], bool),
        [np.frombuffer(b, "<i4") for _, b, _ in sample],
        [np.frombuffer(c, "<f4") for _, _, c in sample],
    )


def severity(text: Column, model: Model) -> Column:
    """Expected severity of a text column, from 0 to the number of grades; null counts as empty."""
    small_batches()
    known, weights, thresholds = model.buckets, model.weights, model.thresholds

    @pandas_udf("double")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = Model(known, weights, thresholds).dense()
        cache: dict[bytes, float] = {}

        def worth(word: bytes) -> float:
            found = cache.get(word)
            if found is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                cache[word] = found = float(dense[features_of(word)].sum(dtype=np.float64))
            return found

        for batch in batches:
            scores = []
            for text in batch:
                words = weighed(text or "")
                total = sum(worth(w) * n for w, n in words.items())
                scores.append(total / sum(words.values()) ** 0.5 if words else -np.inf)
            above = _sigmoid(np.array(scores, float)[:, None] - thresholds)
            yield pd.Series(above.sum(axis=1), dtype=float)

    return of_texts(text)


def score(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """(doc_id, severity, grade, toxic): one row per row of `docs`.

    Rows are independent: repeated rows and null ids stay as they are, other columns
    are ignored. A text without words, null ones too, has severity 0.
    """
    scored = docs.select("doc_id", severity(text_of(), model).alias("severity"))
    return scored.select("doc_id", "severity", F.round("severity").cast("int").alias("grade"), (F.col("severity") >= cut).alias("toxic"))


def keep_clean(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """`docs` without the documents of at least `cut` expected severity; columns as they were."""
    name = free_name(docs, "severity_of_text")
    return docs.withColumn(name, severity(text_of(), model)).filter(F.col(name) < cut).drop(name)
