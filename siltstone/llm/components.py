"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node that edges (a, b) of longs reach; nodes without an edge are absent.

    Both stars reduce every neighbourhood to its smallest member before the shuffle and keep at most as many
    edges as there were; some 2 log2(n) rounds at worst. Each round is written to the shared folder.
    """
    e = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The least are written, so that both sides of the join are plain exchanges and a hub's rows can be split over tasks.
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "stars")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")
        )
        e = materialize(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
