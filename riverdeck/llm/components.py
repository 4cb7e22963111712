"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.session import pinned


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs -> (node, root): each linked node and the smallest node it reaches.

    Alternating large-star and small-star steps: every step replaces links by links to the smallest
    neighbour, until only stars are left, after about log n rounds however long the chains are. The
    smallest neighbour is an aggregate, written before it is joined back, so a hub's links can be
    split among tasks. Each round's links are written to the shared scratch folder.
    """
    a, b = F.col("a"), F.col("b")
    links = pinned(links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
                   "links")
    before = None
    while True:
        both = links.unionByName(links.select(b.alias("a"), a.alias("b")))
        least = pinned(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")
        large = both.filter(b > a).join(least, "a").select(b.alias("a"), F.col("least").alias("b"))
        links = pinned(large.filter(a != b).distinct(), "links")
        least = pinned(links.groupBy("a").agg(F.min("b").alias("least")), "least")
        small = links.join(least, "a").select(F.explode(F.array(
            F.struct(b.alias("a"), F.col("least").alias("b")),
            F.struct(a.alias("a"), F.col("least").alias("b")))).alias("l")).select("l.a", "l.b")
        links = pinned(small.filter(a != b).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return links.select(a.alias("node"), b.alias("root"))
        before = now
