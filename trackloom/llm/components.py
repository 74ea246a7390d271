"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one join-free shuffle of the edges; nothing is collected. Nodes are longs.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (large: the greater ones) are linked to the least of node and neighbours."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    linked = both.join(least, "u")
    out = linked.where("v > u" if large else "true").select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("low").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    ``edges`` has columns u and v; loops and repeated edges do no harm.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    before = None
    while True:
        stars = stored(_star(_star(edges, True), False), label)
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, edges = state, stars
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
