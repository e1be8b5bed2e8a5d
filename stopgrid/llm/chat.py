"""Chat formatting of logged conversations, cumulative snapshots collapsed.

Logs often hold a conversation several times, as it was after each turn. Rolling
hashes name every beginning of a conversation; one whose hash is that of a proper
beginning of another is a snapshot of it and goes, by an anti-join. Conversations that
are equal throughout are one. What is left is rendered turn by turn, so that a long
conversation never has to stand in one row. Only built-in functions are used.

The turns are sorted over the cluster, not per conversation: positions and rolling
hashes are running sums in runs of neighbouring rows, brought together by the sums of
whole runs. So a conversation may hold any share of all turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stopgrid.session import stored

#: Stands for a role that is missing.
UNKNOWN = "unknown"


def segment(role: Column, text: Column) -> Column:
    """One turn as training text."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def _key(id_: Column) -> Column:
    """The conversation as a string that is never null."""
    return F.when(id_.isNull(), "").otherwise(F.concat(F.lit("="), id_.cast("string")))


def _ordered(turns: DataFrame) -> DataFrame:
    """Each different turn once, in order over all conversations: `at` grows with it, `run` is where it lies."""
    given = turns.select(
        F.col("conv_id").alias("conv"), _key(F.col("conv_id")).alias("key"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    order = ["key", F.col("turn").asc_nulls_last(), "role", "text"]
    placed = given.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.select("*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("run")), "turns")


def _earlier(runs: DataFrame, *columns: str) -> DataFrame:
    """Of each conversation's run the sums over its earlier runs; there is at most one row a partition and conversation."""
    before = Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("key", "run", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in columns))


def rolled(conversations: DataFrame) -> DataFrame:
    """(conv, key, position, role, text, s0, s1): the turns with the rolling hash of the conversation up to them.

    The hash is a running sum of hashes of (position, role, text), twice for 128 bits.
    """
    turns = _ordered(conversations)
    runs = turns.groupBy("key", "run").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    runs = stored(runs, "runs")
    places = runs.join(_earlier(runs, "n"), ["key", "run"]).select("key", "run", (F.col("n_before") - F.col("begin")).alias("shift"))
    placed = turns.join(places, ["key", "run"]).withColumn("position", F.col("at") + F.col("shift"))
    content = [F.xxhash64(F.lit(k), "position", "role", "text").cast("decimal(20,0)") for k in (0, 1)]
    hashed = placed.select("conv", "key", "run", "position", "role", "text", *(c.alias(f"h{k}") for k, c in enumerate(content)))
    hashed = stored(hashed, "placed-turns")
    sums = stored(hashed.groupBy("key", "run").agg(F.sum("h0").alias("h0"), F.sum("h1").alias("h1")), "run-hashes")
    within = Window.partitionBy("key", "run").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("conv", "key", "run", "position", "role", "text", *(F.sum(f"h{k}").over(within).alias(f"s{k}") for k in (0, 1)))
    total = running.join(_earlier(sums, "h0", "h1"), ["key", "run"])
    return stored(
        total.select("conv", "key", "position", "role", "text", *((F.col(f"s{k}") + F.col(f"h{k}_before")).alias(f"s{k}") for k in (0, 1))),
        "rolled-turns",
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(key, conv, n_turns, n_logged): one conversation of each that no other continues.

    Of equal ones that with the smallest id stands for all, `n_logged` of them.
    """
    sizes = stored(turns.groupBy("key").agg(F.max("position").alias("position")), "last-turns")
    whole = turns.select("conv", "key", "position", "s0", "s1").join(sizes, ["key", "position"])
    first = F.min(F.struct(F.col("conv").isNull().alias("last"), "conv", "key")).alias("first")
    distinct = whole.groupBy("position", "s0", "s1").agg(first, F.count("*").alias("n_logged"))
    beginnings = (
        turns.select("key", "position", "s0", "s1").join(sizes.withColumnRenamed("position", "last"), "key")
        .filter("position < last").select("position", "s0", "s1").distinct()
    )
    left = distinct.join(beginnings, ["position", "s0", "s1"], "left_anti")
    return stored(left.select("first.key", "first.conv", (F.col("position") + 1).alias("n_turns"), "n_logged"), "maximal")


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, segment, n_turns, n_logged): the turns of the maximal conversations, rendered.

    A conversation's training text is its segments by position, from 0. Turns go by
    number, missing ones last, then by role and text; identical rows count once. A
    missing role is "unknown", a missing text empty, and rows without conv_id are one
    conversation. Other columns are ignored; an empty table gives none.
    """
    turns = rolled(conversations)
    kept = maximal(turns).select("key", "n_turns", "n_logged")
    return turns.join(kept, "key").select(
        F.col("conv").alias("conv_id"), "position", segment(F.col("role"), F.col("text")).alias("segment"), "n_turns", "n_logged"
    )
