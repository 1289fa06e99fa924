"""Connected components by alternating stars.

Every edge points from a larger node to a smaller one. The large star links a
node's larger neighbours to its smallest one, the small star its smaller ones;
when only stars are left, each node points at the smallest of its component. A node
with many edges is only ever reduced with ``min`` or met in a join that Spark
may split, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import discard, staged


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge down or none, and the end of that has none. Nothing would change any more then."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down")).union(edges.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("downs"), F.min("down").alias("least"))
    return not nodes.filter("downs > 1 OR downs > least").agg(F.count("*")).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """Edges (a long, b long), either way round and with repeats, to
    (node long, component long) for each node that is not the smallest of its
    component. An edge from a node to itself or to null is left out."""
    spark = edges.sparkSession
    ends = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, path = staged(ends.distinct(), "component-edges")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("c")).select("a", F.least("a", "c").alias("c"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("c").alias("b"))
        large, large_path = staged(large.distinct(), "component-large")
        low = large.groupBy("a").agg(F.min("b").alias("c"))
        small = large.join(low, "a").filter("b <> c").select(F.col("b").alias("a"), F.col("c").alias("b"))
        small = small.union(low.select("a", F.col("c").alias("b"))).distinct()
        edges, next_path = staged(small, "component-edges")
        discard(spark, large_path)
        discard(spark, path)
        path = next_path
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
