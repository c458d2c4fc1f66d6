"""Copies of one project as a graph of shared keys.

Records that share a DOI are one project, whatever else they say. A record without a DOI
is linked to others by weaker keys, such as its title or its address. Two different DOIs
are never one project, so links must not join them:

* records without a DOI form components over the keys they share with each other;
* a component belongs to a DOI if the records with a DOI that share one of its keys all
  have that one; if they have several, the component stays apart from all of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import stored


def linked(links: DataFrame) -> DataFrame:
    """``node, root`` of all nodes in ``links`` (``a, b``): the smallest node that can be
    reached.

    Every round ties the neighbours of a node to its smallest one, first those above it,
    then those below, until nothing changes; the rounds grow with the logarithm of the
    longest chain. A round aggregates and joins links and never gathers a node's links.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    state = None
    while True:
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        up = stored(
            both.join(least, "a").where((b > a) & (b != F.col("m"))).select(b.alias("a"), F.col("m").alias("b")).distinct(),
            "links",
        )
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        now = stored(down.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if before == state:
            break
    return now.select(a.alias("node"), b.alias("root")).unionByName(
        now.select(b.alias("node"), b.alias("root")).distinct()
    )


def copy_groups(records: DataFrame, id_col: str, doi: Column, keys: Mapping[str, Column]) -> DataFrame:
    """``id_col, copy_of`` of every record. ``copy_of`` names the group: ``d:`` and the
    DOI, or ``i:`` and the smallest id of a component without one. Ids are unique; null
    DOIs and keys are none.

    A key that a third of all records share costs one link per record, as each is tied to
    the smallest record of its key.
    """
    known = stored(
        records.select(F.col(id_col).alias("node"), doi.alias("doi"), *[k.alias(n) for n, k in keys.items()]),
        "keys",
    )
    named = F.explode(
        F.array_compact(
            F.array(*[F.when(F.col(n).isNotNull(), F.concat(F.lit(f"{n}:"), F.col(n))) for n in keys])
        )
    ).alias("key")
    held = known.select("node", "doi", named)
    open_ = held.where("doi is null")
    first = open_.groupBy("key").agg(F.min("node").alias("b"))
    roots = linked(open_.join(first.hint("merge"), "key").select(F.col("node").alias("a"), "b"))
    alone = known.where("doi is null").select("node")
    parts = stored(
        alone.join(roots.hint("merge"), "node", "left").select("node", F.coalesce("root", "node").alias("root")),
        "components",
    )
    # a key needs no more than two of its DOIs to show that it has several
    at_key = held.where("doi is not null").groupBy("key").agg(F.min("doi").alias("low"), F.max("doi").alias("high"))
    keys_of = open_.join(parts.hint("merge"), "node").select("root", "key").distinct()
    claims = (
        keys_of.join(at_key.hint("merge"), "key").groupBy("root")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low = high").select("root", "low")
    )
    without = parts.join(claims.hint("merge"), "root", "left").select(
        F.col("node").alias(id_col),
        F.coalesce(
            F.concat(F.lit("d:"), F.col("low")), F.concat(F.lit("i:"), F.col("root").cast("string"))
        ).alias("copy_of"),
    )
    with_doi = known.where("doi is not null").select(
        F.col("node").alias(id_col), F.concat(F.lit("d:"), F.col("doi")).alias("copy_of")
    )
    return with_doi.unionByName(without)
