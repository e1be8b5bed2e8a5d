"""Connected components of a graph that stays on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopgrid.session import stored


#: A task of a step gets about so many edges; the contracted graph is often small.
EDGES_PER_TASK = 250_000


def _written(df: DataFrame, edges: int, label: str) -> DataFrame:
    """`df`, of about as many rows as there are edges, in as many files as these call for."""
    return stored(df.coalesce(edges // EDGES_PER_TASK + 1), label)


def _least_neighbour(pairs: DataFrame, n: int) -> DataFrame:
    """Per u the smallest of its v. Written, so that the join with it may split a hot u."""
    return _written(pairs.groupBy("u").agg(F.min("v").alias("m")), n, "least")


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both, n).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down, n)
    linked = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (u, v), root being the smallest node it reaches.

    Large and small stars take turns until every node points at its root; each turn
    is written to the shared folder, which also cuts the lineage. Loops and repeated
    edges are ignored; nodes without an edge to another are not returned.
    """
    now = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        n = state[0]
        large = _written(_large_star(now, n).distinct(), n, "large")
        now = _written(_small_star(large, n).distinct(), n, "small")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
