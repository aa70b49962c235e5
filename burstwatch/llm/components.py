"""Connected components of an edge table, on Spark from start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from burstwatch.llm.shared import stored


def connected_components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; the component is its smallest node.

    Alternates the large-star and small-star steps (Kiveris and others, 2014) until a
    round changes nothing: about log(n) rounds, each a few shuffles of at most the edges.
    A hub's neighbours are never collected; only its minimum is, by a partial aggregate.
    ``edges`` are read several times and should be stored; repeated ones do no harm. With
    ``rounds`` it ends after so many: nodes with one label are connected then, but
    a component may still have several labels.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    done, before = 0, None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour is linked to the smallest of the neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every smaller neighbour and the node itself are linked to the smallest
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(
            small.unionByName(lowest.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges"
        )
        done += 1
        if done == rounds:
            break
        if rounds is None:
            now = _sums(edges)
            if now == before:
                break
            before = now
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return labels.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))


def _sums(edges: DataFrame) -> tuple:
    """A digest of the edge set: equal sets give equal digests."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(hash(b, a))")).first())
