"""From raw documents to token ids: five stages, each written and read again.

Toxic documents go, then lines that repeat an earlier one, then near-duplicates but for
one document of each group, then the passages of benchmark items; what is left is
encoded. Each stage works on all that the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stopgrid.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from stopgrid.llm.common import text_of
from stopgrid.llm.queries import table, tokenizer_path
from stopgrid.session import shared_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of little expected severity; the model is fitted on the labelled ones among `docs`."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with only the lines that no earlier line equals but for a word; those with none of their own go."""
    return line_dedup.keep_new_lines(docs, gone=None)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 4-word shingles at 4 bits or fewer."""
    return simhash.keep_one(docs, width=4, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words inside occurrences of 10 consecutive words of a benchmark item."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"), width=10)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document."""
    done = bpe.round_trip(text_of(), tokenizer_path("word_bpe_49k.json"), with_ids=True)
    return docs.select("doc_id", done.alias("done")).select("doc_id", "done.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: SQL cannot express the fitted model, the fingerprints or the encoding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole `documents` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
