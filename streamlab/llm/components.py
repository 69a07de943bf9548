"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.session import written


def _print(edges: DataFrame) -> tuple:
    """Order-free digest of the distinct edges' smallest ends per node: one row to the driver."""
    low = edges.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("c"))
    return tuple(low.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b", "c")), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node it is joined with.

    Each round hangs every node under smaller ones: first the larger neighbours of a node under
    its smallest, then the smaller ones. The number of rounds grows with the logarithm of the
    graph's size. A node with very many edges is one row of an aggregation and, in the join, a
    skewed key that Spark splits. Self-loops and NULL ids are left out.
    """
    start = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(start, "edges")
    seen = _print(now)
    while True:
        # dealt out by node once per star: what follows needs no further exchange
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).repartition("a").distinct()
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).repartition("a").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
        )
        now = written(small, "edges")
        after = _print(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).distinct().unionByName(roots)
