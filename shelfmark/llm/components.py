"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link; ``root`` is the smallest node of
    its component. ``links`` has columns ``a`` and ``b``.

    Large-star and small-star steps alternate until the links no longer change: every
    node is tied to the smallest neighbour, first those above it, then those below.
    Each step is one aggregation and one join over links; its result is a table in the
    shared folder. A step never gathers the links of a node.
    """
    a, b = F.col("a"), F.col("b")
    current = stored(
        links.where(a != b)
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        both = current.unionByName(current.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = (
            both.join(least, "a").where(b > a)
            .select(b.alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = stored(large.where(a != b), "links")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
            .unionByName(down.select("a", F.col("m").alias("b")))
            .distinct()
        )
        current = stored(small, "links")
        now = current.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("b % 1000003"))
        ).first()
        if now == mark:
            break
        mark = now
    return current.select(a.alias("node"), b.alias("root")).unionByName(
        current.select(b.alias("node"), b.alias("root")).distinct()
    )
