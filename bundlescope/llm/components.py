"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlescope.llm.arrow import stored


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """node, component (smallest node reachable) of every node in links a, b.

    Large-star and small-star steps in turn: each node hands its smallest
    neighbour to its larger, then to its smaller neighbours, until every node is
    linked with its component's smallest node alone. A node with very many
    neighbours only needs their minimum, which map tasks reduce. Every round is a
    table in the shared folder; the driver sees one row of counts per round.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    rows = stored(links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), label)
    before = None
    while True:
        now = rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
        both = rows.union(rows.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").where("b <> least")
        large = large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        pairs = large.join(least, "a")
        small = pairs.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        rows = stored(small.union(least).distinct(), label)
    ends = rows.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return rows.select(F.col("a").alias("node"), F.col("b").alias("component")).union(ends)
