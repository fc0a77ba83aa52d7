"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kiln.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).hint("merge")
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).hint("merge")
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Each step is a pre-aggregated minimum and a join, so a node with very many
    neighbours is never gathered; each round is written, observed as it is
    written, and the loop ends when a round changes no edge.  Both sides of the
    joins are dealt by node already; none is broadcast, as what is broadcast
    stays with the driver until it collects its garbage.  Edges from a
    node to itself are ignored; nodes without an edge are not returned.
    """
    now, mark = _seen(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), what)
    while True:
        after, state = _seen(_small(_large(now)).where("a <> b"), what)
        if state == mark:
            # every node now has one edge, to the least of its component
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        now, mark = after, state


def _seen(edges: DataFrame, what: str) -> tuple[DataFrame, tuple]:
    """The distinct edges, written, with their number and a sum over their hashes."""
    seen = Observation()
    out = written(
        edges.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")), what
    )
    return out, (seen.get["n"], seen.get["s"])
