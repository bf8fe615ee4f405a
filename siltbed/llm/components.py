"""Connected components of links between 64-bit nodes, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.sources.session import staged


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of its component.

    Alternates the large-star and small-star steps: every node hands its larger, then its
    smaller neighbours to the smallest node it knows. Both are an aggregate and a join on the
    node, so a hub is a hot key of a join, which adaptive execution can split, and never a
    list in one task. Rounds grow with the logarithm of the longest chain. Each round is a
    table in the checkpoint folder, which a lost executor does not take along.
    """
    edges = staged(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = large.where("u <> v").distinct()
        lower = kept.groupBy("u").agg(F.min("v").alias("m"))
        small = kept.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(lower.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # The sum of digests tells whether the set of links has changed.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct())
