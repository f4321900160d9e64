"""Connected components of a table of links, by alternating star steps.

Links point from a node to a smaller one. The small step hangs all smaller neighbours of a node on
the least of them, the large step hangs all larger neighbours of a node on its least neighbour. Each
step is a grouping (combined before the shuffle) and a join; the grouped side is stored first, so
that adaptive execution sees both sides of the join as plain shuffles and can split a hub. Rounds go
on until nothing changes; the driver only learns whether something did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate.sources.tables import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) for each node with a smaller one in its component.

    ``links`` has columns a and b, in any order, repeats and loops allowed; nulls are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("p"), F.lit(True).alias("changed"))
    edges = stored(edges.where("a is not null and b is not null and a != b").distinct(), "links")
    while not edges.where("changed").isEmpty():
        least = stored(edges.groupBy("v").agg(F.min("p").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        more = edges.join(least.where("n > 1").select("v", "m"), "v").where("p != m")
        small = least.select("v", F.col("m").alias("p"), F.lit(False).alias("changed")).unionByName(
            more.select(F.col("p").alias("v"), F.col("m").alias("p"), F.lit(True).alias("changed"))
        )
        small = stored(small, "small")
        root = stored(small.groupBy("v").agg(F.min("p").alias("m")), "root").select(F.col("v").alias("p"), "m")
        large = small.join(root, "p", "left").select(
            "v", F.coalesce("m", "p").alias("p"), (F.col("changed") | F.col("m").isNotNull()).alias("changed")
        )
        edges = stored(large.groupBy("v", "p").agg(F.max("changed").alias("changed")), "links")
    return edges.select(F.col("v").alias("node"), F.col("p").alias("component"))
