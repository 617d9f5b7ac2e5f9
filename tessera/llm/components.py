"""Connected components by alternating large and small stars.

Each round is a handful of joins and combined aggregations over the edges; hubs
are met by minimum aggregations with map-side combine and by joins that adaptive
execution can split, never by collecting neighbours. Lineage is cut every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that can be reached, for every node of an edge.

    Loops and repeated edges are harmless; no edges give no rows.
    """
    links = cut(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        # large star: every larger neighbour of u moves to the least of u's neighbours and u
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and u itself move to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        joined = large.join(least, F.col("u") == F.col("k"))
        small = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut(small.union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct())
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
