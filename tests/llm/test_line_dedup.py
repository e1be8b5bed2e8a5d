"""Lines that stay, beside a comparison of every line with every earlier one."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stopgrid.llm import line_dedup
from stopgrid.llm.bitmaps import bitmap, may_match


def words(line):
    return re.sub(r"\s+", " ", line.lower()).strip(" ").split(" ")


def distance(a, b):
    """Levenshtein distance of two lists of words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(rows, min_words=8):
    lines = [(i, k, words(x)) for i, t in rows for k, x in enumerate((t or "").split("\n"))]
    lines = [(i, k, w) for i, k, w in lines if w != [""] and len(w) >= min_words]
    out = []
    for i, t in rows:
        kept = []
        for k, x in enumerate((t or "").split("\n")):
            w = words(x)
            if w == [""] or len(w) < min_words or not any(
                (j, m) < (i, k) and abs(len(o) - len(w)) <= 1 and distance(o, w) <= 1 for j, m, o in lines
            ):
                kept.append(x)
        out.append((i, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    return sorted(out)


def found(docs, **more):
    rows = line_dedup.dedup_lines(docs, **more).collect()
    return sorted((r["id"], r["n_lines"], r["n_dropped"], r["text"]) for r in rows)


def made(rng, n):
    return " ".join(rng.choice(["the", "of", "and", *(f"w{i}" for i in range(40))]) for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_random_edits(make_docs, seed):
    rng = random.Random(seed)
    bases = [made(rng, rng.choice([8, 9, 10, 15, 30])) for _ in range(12)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(bases).split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                kind = rng.randrange(3)
                w = w[:at] + ([] if kind == 0 else ["new%d" % rng.randrange(3)]) + w[at + (kind < 2) :]
            lines.append(" ".join(w).title() if rng.random() < 0.2 else " ".join(w))
        lines += rng.choice([[], [""], ["short line"], [made(rng, 7)]])
        rows.append((i, "\n".join(lines)))
    assert found(make_docs(rows)) == plain(rows)


def test_repeated_words(make_docs):
    rows = [(1, "a a a a a a a a"), (2, "a a a a a a a a a"), (3, "a a a a a a a b a"), (4, "a a a a b a a b"), (5, "a a a a a a a")]
    assert found(make_docs(rows)) == plain(rows)


def test_many_lines_that_differ_in_one_word(make_docs):
    """One group of equal variants; its members are not paired with each other."""
    rows = [(i, f"page {i} of the long report on all the things") for i in range(500)]
    result = found(make_docs(rows))
    assert [r[2] for r in result] == [0] + [1] * 499


def test_odd_rows(make_docs):
    line = "one two three four five six seven eight"
    long = "\n".join(f"{line} {i}" for i in range(1, 20)) + "\n" + " ".join(f"w{i}" for i in range(2_000))
    rows = [(3, f"{line}\r\n\n  {line.upper()}\t \n{line}"), (1, None), (2, ""), (4, f"{line}\n{line.replace('two', '2')}"), (5, long), (6, long.replace("w1999", "end"))]
    assert found(make_docs(rows)) == plain(rows)


def test_repeated_rows_and_null_ids(make_docs):
    line = "one two three four five six seven eight"
    rows = [(1, line), (1, line), (2, line), (None, line)]
    result = line_dedup.dedup_lines(make_docs(rows)).collect()
    assert sorted(((r["id"], r["n_dropped"]) for r in result), key=str) == sorted([(1, 1), (1, 1), (2, 1), (None, 0)], key=str)
    twice = line_dedup.dedup_lines(make_docs([(1, line), (1, line), (2, line)])).collect()
    assert sorted((r["id"], r["n_dropped"]) for r in twice) == [(1, 0), (1, 0), (2, 1)]


def test_documents_that_go(make_docs, clash):
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, a), (2, f"{a}\nshort"), (3, f"{a}\n{b}"), (4, None), (5, ""), (6, "short")]
    kept = line_dedup.keep_new_lines(make_docs(rows))
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()) == [
        (1, a, len(a)), (3, b, len(b)), (4, None, None), (5, "", 0), (6, "short", 5),
    ]
    docs = clash([(1, a), (2, f"{b}\n{a}")], lines="l", kept="k", r1="r", no="n", carry="c", id="i", words="w")
    out = line_dedup.keep_new_lines(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["lines"], r["carry"]) for r in out.collect()) == [(1, a, "l", "c"), (2, b, "l", "c")]


def test_documents_with_own_text_stay(make_docs, spark):
    """The pipeline's stage: however much is shared, a document with a line of its own stays."""
    rng = random.Random(8)
    notice, own = "\n".join(made(rng, 20) for _ in range(34)), "\n".join(made(rng, 20) for _ in range(6))
    rows = [
        (1, notice), (2, f"{notice}\n{own}"), (3, f"{notice}\n\n  "), (4, f"{notice}\nown end"), (5, f"{notice}\nOwn  end\n"),
        (6, "own end"), (7, None), (8, ""), (9, f"{notice}\n{own}"), (9, f"{notice}\n{own}"), (10, f"{notice}\nnew end"),
        (10, f"{notice}\nnew end"), (None, f"{notice}\nlast end"), (11, f"last end\n{notice}"),
    ]
    assert 0.8 < len(notice) / len(f"{notice}\n{own}") < 0.9
    left = corpus_pipeline.without_repeated_lines(spark, make_docs(rows), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=str) == sorted(
        [(None, rows[12][1]), (2, own), (4, "own end"), (6, "own end"), (7, None), (8, ""), (10, "new end"), (10, "new end")], key=str
    )


def test_lines_of_few_words_that_are_long(make_docs, spark):
    """Equal ones go by their characters, near ones stay; the word floor alone leaves them all."""
    chinese, token, few = "\u6587" * 10_000, "QUJD" * 20, "seven words of a rather long footnote"
    assert len(few) < 40 <= len(f"{few} here") and len(f"{few} here".split()) == 8
    few = f"{few}{'s' * 5}"
    rows = [
        (1, f"{chinese}\n{token}\n{few}\nshort"), (2, f"{chinese}\nshort\nown"), (3, f"  {token} \nother"),
        (4, f"{few.upper()}\n{few.replace('seven', 'eight')}"), (5, f"{token}\n{'x' * 39}\n{'x' * 39}\n{'y' * 40}\n{'y' * 40}"),
    ]
    left = {1: rows[0][1], 2: "short\nown", 3: "other", 4: few.replace("seven", "eight"), 5: f"{'x' * 39}\n{'x' * 39}\n{'y' * 40}"}
    assert {r[0]: r[3] for r in found(make_docs(rows))} == left
    staged = corpus_pipeline.without_repeated_lines(spark, make_docs(rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in staged} == left
    assert found(make_docs(rows), min_chars=None) == plain(rows)


def test_empty_table(make_docs):
    assert found(make_docs([])) == []
    assert line_dedup.keep_new_lines(make_docs([])).count() == 0


def test_within_one_edit(spark):
    rng = random.Random(2)
    rows = [([rng.choice("ab") for _ in range(rng.randint(1, 6))], [rng.choice("ab") for _ in range(rng.randint(1, 6))]) for _ in range(300)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    for a, b, near in df.select("a", "b", line_dedup.within_one_edit(F.col("a"), F.col("b"))).collect():
        assert near == (distance(a, b) <= 1)


def test_bitmap(spark):
    some = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("h"))
    every = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    passed = {r["id"] for r in may_match(every, F.col("h"), bitmap(some, F.col("h"))).collect()}
    assert set(range(0, 5000, 7)) <= passed and len(passed) < 730


def test_words_are_gone_through_once(make_docs, monkeypatch):
    """The neighbourhood is made once and read twice, from lines dealt as a whole; texts are lowered once."""
    plans, write = {}, line_dedup.stored

    def noted(df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(line_dedup, "stored", noted)
    line = "one two three four five six seven eight"
    rows = [(1, line), (2, line.replace("two", "2")), (3, f"{line.upper()}\n{line} nine")]
    assert found(make_docs(rows)) == plain(rows)
    assert [label for label, made in plans.items() if any("Window" in plan for plan in made)] == ["variants"]
    (variants,), (lines,) = plans["variants"], plans["lines"]
    assert variants.index("Generate posexplode") < variants.index("RepartitionByExpression")
    assert lines[lines.index("Generate posexplode") :].count("lower(") == 1


def test_normal_form_of_odd_texts(spark):
    """Whether blanks or capitals are done with first makes no difference."""
    rng = random.Random(5)
    signs = ["a", "B", "Σ", "Α", "İ", "ẞ", "'", ".", "́", " ", " ", " ", "  ", "\t", "\r", "\f", "\x0b", "\n"]
    rows = [("".join(rng.choice(signs) for _ in range(rng.randint(0, 12))),) for _ in range(2_000)]
    first = F.regexp_replace(F.lower("text"), "[ \\t\\x0B\\f\\r]+", " ")
    df = spark.createDataFrame(rows, "text string").select(line_dedup.normal(F.col("text")).alias("now"), first.alias("then"))
    assert df.filter("now <> then").count() == 0


@pytest.mark.parametrize("hashes", [range(64), [-1], [], range(0, 1 << 23, 8_191)])
def test_bitmap_bit_by_bit(spark, hashes):
    some = spark.createDataFrame([(h,) for h in hashes], "h long")
    every = spark.createDataFrame([(h + d,) for h in [*hashes, 5] for d in (-8, -1, 0, 1, 8)], "h long").distinct()
    passed = {r["h"] for r in may_match(every, F.col("h"), bitmap(some, F.col("h"))).collect()}
    mask = (1 << 23) - 1
    assert passed == {r["h"] for r in every.collect() if r["h"] & mask in {h & mask for h in hashes}}
