"""Caps on accepted records, per source or per (source, search term)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import stored

# Up to this many rows per group Spark limits every group before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
# One of so many records tells how far the rows of a term can matter.
SLICES = 32


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    """Equal columns, null being equal to null."""
    tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, tests)


def _tie(df: DataFrame) -> Column:
    """A hash of the whole row: it tells rows of one place apart, but for equal ones."""
    return F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def cap_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, limit: Column | None = None
) -> DataFrame:
    """First ``n`` rows of every group by ``order``. Nulls come first in the order, and
    rows with a null group are a group. Rows of one place follow each other by a hash of
    the row, so a group of more rows gives exactly ``n`` of them, and the same ones on
    both ways. ``limit`` is a cap that differs by group, at most ``n``: an expression of
    the group columns.

    A small ``n`` is cut before the shuffle, whatever the group sizes. For a large one
    the places alone are counted and dealt to ranges of (group, order), so a large group
    lies in many ranges; running totals over the ranges tell where the cap falls, and only
    that range is looked at place by place. The rows themselves are compared with the last
    place inside the cap.
    """
    cap = F.lit(n) if limit is None else limit
    if n <= GROUP_LIMIT:
        ranked = df.withColumn("_tie", _tie(df))
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order, "_tie"))
        kept = ranked.withColumn("_rank", rank).filter((F.col("_rank") <= n) & (F.col("_rank") <= cap))
        return kept.select(*df.columns)
    last = stored(last_places(df, group, order, cap), "last-places")
    joined = df.withColumn("_tie", _tie(df)).alias("d").join(last.alias("l"), _same(group, "d", "l"), "left")
    place = F.struct(*[F.col(f"d.{c}") for c in [*order, "_tie"]])
    inside = joined.filter(F.col("l._last").isNull() | (place < F.col("l._last"))).select("d.*")
    # equal rows at the last place: as many of them as are missing, whichever
    ends = df.withColumn("_tie", _tie(df)).alias("d").join(last.alias("l"), _same(group, "d", "l"))
    ends = ends.filter(place == F.col("l._last")).select("d.*", "l._left")
    columns = [c for c in df.columns if c not in group]
    equal = ends.groupBy(*group, "_tie").agg(
        F.any_value(F.struct(*columns)).alias("_row"), F.any_value("_left").alias("_left")
    )
    copies = equal.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left"))))
    return inside.select(*df.columns).unionByName(copies.select(*group, "_row.*").select(*df.columns))


def last_places(df: DataFrame, group: Sequence[str], order: Sequence[str], cap: Column | int) -> DataFrame:
    """The place at which every group of more rows reaches the cap: the group columns, the
    order columns and the row's hash as the struct ``_last``, and ``_left``, the number of
    rows there that are still inside."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    by = [*order, "_tie"]
    places = stored(
        # counted first, so equal rows are one, however many
        df.select(*group, *order, _tie(df).alias("_tie"))
        .groupBy(*group, *by).agg(F.count(F.lit(1)).alias("_n"))
        .repartitionByRange(*group, *by)
        .withColumn("_range", F.spark_partition_id()),
        "places",
    )
    sizes = places.groupBy(*group, "_range").agg(F.sum("_n").alias("_size"))
    # one row per range that the group touches
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    border = (
        sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .filter((F.col("_before") < cap) & (F.col("_before") + F.col("_size") >= cap))
        .select(*group, "_range", "_before")
    )
    inside = places.alias("p").join(border.alias("b"), _same([*group, "_range"], "p", "b"))
    so_far = F.sum("_n").over(Window.partitionBy(*group).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    return (
        inside.select("p.*", "b._before")
        .withColumn("_rank", F.col("_before") + so_far)
        .filter((F.col("_rank") >= cap) & (F.col("_rank") - F.col("_n") < cap))
        .select(*group, F.struct(*by).alias("_last"), (cap - F.col("_rank") + F.col("_n")).cast("long").alias("_left"))
    )


def cap_per_source(
    df: DataFrame,
    n: int,
    source: str = "context_repository",
    order: Sequence[str] = ("term_rank", "page", "pos"),
) -> DataFrame:
    """First ``n`` accepted records of every source."""
    return cap_per_group(df, [source], list(order), n)


def cap_per_term(
    hits: DataFrame,
    n: int,
    source: str = "context_repository",
    record: str = "recid",
    order: Sequence[str] = ("page", "pos"),
) -> DataFrame:
    """Walk the terms in rank order and take up to ``n`` hits under each, of records that
    no earlier term took.

    A record beyond the cap of one term may still enter under a later one, so this is
    not a plain rank. But the terms before take no more than ``n`` records each, so under
    the term at place ``t`` (from 0) only the first ``n * (t + 1)`` records of a source
    can matter. One slice of the records bounds where these can lie, so that hits beyond
    do not move; the hits of others are left out by one cap; what remains is walked source
    by source in sorted rows, holding no more than the ids taken so far. The number of
    jobs does not grow with the terms. The ranks are those in the hits, with whatever gaps
    they have; hits without a rank come first.
    """
    hits_ = stored(hits.withColumn("_tie", _tie(hits)), "hits")
    ranks = [r[0] for r in hits_.select("term_rank").distinct().collect()]  # search terms
    if not ranks:
        return hits.limit(0)
    ranked = F.array(*[F.lit(r) for r in sorted(r for r in ranks if r is not None)])
    place = F.array_position(ranked.cast(f"array<{dict(hits.dtypes)['term_rank']}>"), F.col("term_rank"))
    at = F.coalesce(place - int(None not in ranks), F.lit(0)).cast("int")
    placed = _within_reach(hits_.withColumn("_at", at), n, source, record, order)
    records = _records(placed, source, record, order)
    matter = stored(
        cap_per_group(records, [source, "_at"], list(order), n * len(ranks), F.lit(n) * (F.col("_at") + 1)),
        "records",
    )
    rows = (
        placed.alias("h").join(matter.alias("m"), _same([source, record, "_at"], "h", "m"), "left_semi")
        .repartition(source).sortWithinPartitions(source, "_at", *order, "_tie")
    )
    names = placed.columns
    walk = _walk(n, *[names.index(c) for c in (source, record, "_at")])
    return rows.select(*names).mapInArrow(walk, placed.schema).select(*hits.columns)


def _records(placed: DataFrame, source: str, record: str, order: Sequence[str]) -> DataFrame:
    """Every record of a source and term at its first place."""
    first = placed.groupBy(source, record, "_at").agg(F.min(F.struct(*order)).alias("_place"))
    return first.select(source, record, "_at", "_place.*")


def _within_reach(
    placed: DataFrame, n: int, source: str, record: str, order: Sequence[str], slices: int = SLICES
) -> DataFrame:
    """Hits at or before a place up to which ``n * (t + 1)`` records lie: where one slice of
    the records, chosen by hash, has that many already, all of them have no fewer. ``n`` of
    these records no earlier term took, so no hit beyond is taken. Terms of which the slice
    has fewer records keep all hits."""
    part = placed.filter(F.pmod(F.xxhash64(record), F.lit(slices)) == 0)
    records = stored(_records(part, source, record, order), "slice")
    reach = stored(last_places(records, [source, "_at"], order, F.lit(n) * (F.col("_at") + 1)), "reach")
    beyond = F.struct(*[F.col(f"h.{c}") for c in order]) > F.struct(*[F.col(f"r._last.{c}") for c in order])
    joined = placed.alias("h").join(reach.alias("r"), _same([source, "_at"], "h", "r"), "left")
    return joined.filter(F.col("r._last").isNull() | ~beyond).select("h.*")


def _walk(
    n: int, source: int, record: int, at: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order to those that are taken; the columns are given by their places. A
    source is walked from its first to its last row; the ids taken, ``n`` per term, are
    all that is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, taken, fresh, room = None, set(), set(), 0
        for batch in batches:
            keep = []
            for now in zip(*(batch.column(c).to_pylist() for c in (source, at, record))):
                if here is None or here[0] != now[0]:
                    here, taken, fresh, room = now[:2], set(), set(), n
                elif here != now[:2]:
                    here, room = now[:2], n
                    taken |= fresh
                    fresh = set()
                keep.append(room > 0 and now[2] not in taken)
                if keep[-1]:
                    fresh.add(now[2])
                    room -= 1
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run
