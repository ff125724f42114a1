"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and sum of hashes: equal marks mean equal tables."""
    hashed = F.xxhash64("high", "low").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``(node, root)`` of every node in ``links`` (columns ``a``, ``b``); root is the least.

    Rounds of large and small stars: each node hands its greater neighbours to its least
    neighbour, then its smaller ones. The number of rounds grows with the logarithm of the
    longest path. Only minima are taken per node, so a node with any number of links is
    combined before it is shuffled. Each round is stored. ``rows``: a bound on the nodes.
    """
    edges = stored(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), rows)
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = stored(both.groupBy("node").agg(F.min("other").alias("least")), rows)
        large = stored(
            both.where(F.col("other") > F.col("node")).join(least, "node")
            .select(F.col("other").alias("high"), F.least("node", "least").alias("low")), rows)
        lowest = stored(large.groupBy("high").agg(F.min("low").alias("least")), rows)
        small = large.join(lowest, "high").where(F.col("low") != F.col("least")).select(
            F.col("low").alias("high"), F.col("least").alias("low"))
        edges = stored(small.unionAll(
            lowest.select("high", F.col("least").alias("low"))).distinct(), rows)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select("low").distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(
        roots.select(F.col("low").alias("node"), F.col("low").alias("root")))
