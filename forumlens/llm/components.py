"""Connected components of links, by joins and minima alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.session import keep


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes in ``links`` (``a, b``, numbers, either order).

    ``component`` is the smallest node reachable. Every round links each node's
    larger neighbours to the smallest of its neighbourhood, then its smaller
    ones, until nothing changes; rounds grow with the logarithm of the longest
    path, and a node with many neighbours is never brought together, as only
    minima are taken. Each round's links are written to the shared folder.
    Links of a node with itself and null ends are left out.
    """
    clean = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = keep(clean, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.col("n"), F.min("b")).alias("m"))
        large = both.join(low, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = keep(large.where("a <> b").distinct(), "links")
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        joined = large.join(least, F.col("a") == F.col("n"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        edges = keep(small.where("a <> b").distinct(), "links")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    # At rest every node points at its component's smallest
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
