"""Connected components of links, as Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsieve.llm.common import stored


def smallest_reachable(links: DataFrame) -> DataFrame:
    """id, component: of every id in ``links`` (a, b), the smallest it reaches.

    Alternates two kinds of star: each id hands the smallest of its neighbours to
    the larger ones, then to the smaller ones. The number of rounds grows with the logarithm
    of the longest chain. Hubs are met by a minimum combined on the map side and a join that
    adaptive execution can split.
    """
    smaller, larger = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(
        links.where("a <> b").select(larger.alias("u"), smaller.alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        outward = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        lowest = outward.groupBy("u").agg(F.min("v").alias("m"))
        inward = outward.join(lowest, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = stored(inward.select("e.u", "e.v").where("u <> v").distinct(), "links")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
        ).first()
        if before == state:
            break
        before = state
    own = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(own)
