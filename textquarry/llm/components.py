"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.runtime import discard, durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of its component.

    Large-star and small-star rounds (Kiveris et al., 2014), each written to
    the shared folder, until a round changes nothing; a round's tables go once
    the next one's are there. What a round needs of a
    node's neighbours is their least, a partial aggregate; no neighbourhood is
    gathered. Empty edges give no rows; loops are ignored.
    """
    now = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    sign = None
    while True:
        # Every larger neighbour of u is linked to the least of u's neighbourhood.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = durable(large.distinct())
        # u and its smaller neighbours are linked to the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(least.select("u", F.col("m").alias("v")))
        before, now = now, durable(small.distinct())
        discard(before, large)
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == sign:
            break
        sign = tuple(found)
    # Now each component is a star around its least node.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
