"""Connected components of an edge list, by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import stored


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(pairs: DataFrame) -> DataFrame:
    """Link every neighbour of a node to the smallest of them; ``low`` is that smallest."""
    low = pairs.groupBy("a").agg(F.min("b").alias("low"))
    # The hint keeps the minima from being collected for a broadcast, round after round.
    low = low.select("a", F.least("a", "low").alias("low")).hint("merge")
    return pairs.join(low, "a")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)`` but the roots themselves, where the root is the
    smallest node that can be reached. Nothing gathers a component: each step is a minimum for each
    node and a join, and each round's edges are stored in the shared folder."""
    edges = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = _star(large)
        small = (
            small.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(small.select("a", F.col("low").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        edges = stored(small, "edges")
        after = _digest(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
