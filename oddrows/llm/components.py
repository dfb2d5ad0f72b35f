"""Connected components of a table of links, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrows.functions.lineage import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (smallest node reachable) of every node that has a link.

    Large-star and small-star steps in turn until nothing changes: each step hangs neighbours
    under the smallest known node, so stars grow and chains halve. Every round is written, the
    smallest neighbour is found by a combined aggregate, and long neighbour lists are never gathered."""
    def hung(pairs: DataFrame, of: str, at: str) -> DataFrame:
        low = pairs.groupBy(of).agg(F.min(at).alias("_low")).select(F.col(of).alias("_of"), F.least("_of", "_low").alias("_low"))
        return pairs.join(low, pairs[of] == low["_of"])

    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs = written(pairs)
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hung(both, "u", "v").filter("v > u").select(F.col("v").alias("u"), F.col("_low").alias("v")).distinct()
        star = hung(large, "u", "v")
        small = star.select("u", F.col("_low").alias("v")).unionByName(
            star.select(F.col("v").alias("u"), F.col("_low").alias("v")).filter("u <> v")).distinct()
        pairs = written(small)
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
