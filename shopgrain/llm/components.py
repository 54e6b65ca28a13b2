"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (a, b); root is the smallest
    node of its component. Self loops and repeated edges do no harm.

    Each pass is two joins on node and is stored, so lost executors cost one pass
    at most; the number of passes grows with the logarithm of the largest
    component. A node with many edges is a hot join key, which adaptive execution
    splits; minima are taken with partial aggregation.
    """
    edges = store(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")
        ).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
        edges = store(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b"), F.col("b")).distinct()
    )
