"""Connected components of links, by rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``links`` (``a, b``): the least node that links lead to.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to its least
    neighbour, then its smaller ones. Every round is a written table; the number of rounds grows with
    the logarithm of the nodes. A node with very many links is met by AQE's skew joins: its least
    neighbour is an aggregate that shrinks before the shuffle.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links"
    )
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "links-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links-small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == before:
            break
        before = now
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
