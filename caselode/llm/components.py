"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselode.session import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node is tied to the smallest node it knows, seen from above, then from below.

    Edges run from the greater node `u` to the smaller `v`. Each half groups by node with a map-side
    minimum and joins that back, so a node with very many links is one row until the join.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.filter("u != v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(
        F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                          F.struct("u", F.col("m").alias("v")))).alias("e")
    ).select("e.u", "e.v")
    return small.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of `links` (a, b); the root is the component's smallest node.

    Links may repeat, run either way and join a node to itself; nulls and self-links are passed
    over. Without links the result is empty. Every round is written to the shared folder, so a
    lost executor costs one round at most.
    """
    edges = links.dropna().select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(edges.filter("u != v").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        edges = staged(_stars(edges), "edges")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
