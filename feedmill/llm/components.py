"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedmill.session import cut


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node of its component) for the nodes of ``links`` (a, b).

    Alternates large stars and small stars: every node's larger, then every node's smaller
    neighbours are tied to the smallest one in reach, until nothing changes. Only minima are
    computed, which combine in the tasks, so a node may have any number of neighbours. Each
    round is a stored table; it raises when ``most_rounds`` are not enough.
    """
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        around = edges.select(F.explode(both).alias("e")).select("e.u", "e.v")
        lowest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(lowest, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        # Of each node only smaller neighbours are left: tie them and the node to the smallest.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.explode(F.array(
            F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        state = tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before:
            root = edges.groupBy("b").agg(F.min("a").alias("component")).withColumnRenamed("b", "node")
            roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            return root.unionByName(roots)
        before = state
    raise RuntimeError(f"components are not settled after {most_rounds} rounds")
