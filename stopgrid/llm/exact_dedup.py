"""Exact duplicates with the frequent texts split off.

A Misra-Gries summary finds the digests that may be frequent. They are at most as many
as its size, so their exact counts may be broadcast and their rows are settled where
they lie, without a shuffle. All other digests are rare by the summary's guarantee and
meet in an ordinary shuffle. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopgrid.llm.common import ascii_lower, free_name, text_of
from stopgrid.session import stored

#: A digest in at least this share of the rows is settled without a shuffle. The
#: summary holds one digest more than its inverse at most.
SHARE = 0.002


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), F.sha2(F.encode(ascii_lower(text_of(text_col)), "UTF-8"), 256).alias("digest")
    )


def heavy_hitters(marked: DataFrame, share: float = SHARE) -> DataFrame:
    """(digest, keep_id, group_size) of the frequent digests, counted exactly.

    The summary never misses a digest above its share; what it names besides is
    counted all the same, and does no harm.
    """
    names = marked.stat.freqItems(["digest"], share).first()[0] or []
    named = marked.sparkSession.createDataFrame([(d,) for d in names], T.StructType([T.StructField("digest", T.StringType())]))
    exact = marked.join(F.broadcast(named), "digest", "left_semi")
    return stored(_settled(exact), "heavy")


def _settled(marked: DataFrame) -> DataFrame:
    return marked.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))


def mark(docs: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, digest): one row per row of `docs`.

    Texts are equal when they are identical after lower-casing A-Z; null counts as
    empty, and empty texts are equal. The row with the largest id stays. Rows that
    repeat this id with an equal text are all marked kept, as nothing tells them
    apart; null ids are never the largest, and a group of null ids only keeps all of
    them under a null keep_id. Other columns are ignored; an empty table gives none.
    """
    marked = stored(digests(docs, id_col, text_col), "digests")
    heavy = heavy_hitters(marked, share)
    common = marked.join(F.broadcast(heavy), "digest")
    rest = marked.join(F.broadcast(heavy), "digest", "left_anti")
    rare = rest.join(stored(_settled(rest), "rare"), "digest")
    return common.unionByName(rare).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def keep_largest(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """`docs` without the rows whose text a row with a larger doc_id repeats, columns as they were."""
    id_, digest = free_name(docs, "kept_id"), free_name(docs, "kept_digest")
    kept = mark(docs, share).filter("kept").select(F.col("id").alias(id_), F.col("digest").alias(digest)).distinct()
    own = F.sha2(F.encode(ascii_lower(text_of()), "UTF-8"), 256)
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept[id_]) & (own == kept[digest]), "left_semi")
