"""Connected components of a graph that is too large for one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import stored


def hooked(edges: DataFrame, larger: bool) -> DataFrame:
    """One round over (a, b): each node's neighbours are tied to the least node among them and itself.

    With `larger`, only neighbours above the node move (all edges seen from both ends); without, only those
    below it, and the node itself (edges seen from their larger end).
    """
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = edges.unionByName(back) if larger else edges.unionByName(back).where("a > b")
    least = seen.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    # Written, or the join would keep the aggregate's partitions and could not split a node with very many edges.
    least = stored(least, "least")
    joined = seen.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    ties = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return ties.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b), long numbers; the root is the least node.

    Alternates both rounds until the edges are stars and stay so: about log n rounds, each written to the
    shared folder. Nothing is collected but a count and a checksum of the edges.
    """
    edges = stored(edges.where("a != b").select("a", "b"), "edges")
    before = None
    while True:
        edges = stored(hooked(hooked(edges, larger=True), larger=False), "edges")
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = edges.agg(F.count("*").alias("n"), digest.alias("digest")).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
