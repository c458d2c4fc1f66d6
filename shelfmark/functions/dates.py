"""Date ranges for partitioning a harvest by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_part(iso_time: Column) -> Column:
    return F.split_part(iso_time, F.lit("T"), F.lit(1))


def date_range_chunks(limits: DataFrame, until: str, from_year: int, months: int) -> DataFrame:
    """Closed month chunks from January of ``from_year`` up to ``until``.

    Adds ``chunk_start`` and ``chunk_end`` for every row of ``limits``. No chunk
    starts on ``until``; a start at or after it gives the single given pair.
    """
    start = F.make_date(F.lit(from_year), F.lit(1), F.lit(1))
    until_date = F.col(until).cast("date")
    starts = F.when(
        start < until_date,
        F.filter(
            F.sequence(start, until_date, F.make_interval(months=F.lit(months))),
            lambda s: s < until_date,
        ),
    ).otherwise(F.array(start))
    ends = F.least(F.date_sub(F.add_months("chunk_start", months), 1), until_date)
    return limits.withColumn("chunk_start", F.explode(starts)).withColumn(
        "chunk_end", F.when(start < until_date, ends).otherwise(until_date)
    )


def chunk_start(date: Column, from_year: int, months: int) -> Column:
    """Start of the chunk a date falls into, so that rows meet their chunk by an
    equi-join and not by a range comparison."""
    elapsed = (F.year(date) - from_year) * 12 + F.month(date) - 1
    back = elapsed % months
    return F.add_months(F.trunc(date, "month"), -back)


def date_range_slices(limits: DataFrame, start: str, end: str, n: int) -> DataFrame:
    """``n`` equal slices of [start, end] that share endpoints, in UTC dates."""
    first = F.col(start).cast("date")
    last = F.col(end).cast("date")
    days = F.datediff(last, first)
    numbers = F.when(first < last, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))

    def at(k: Column) -> Column:
        return F.date_add(first, F.floor(k * days / n).cast("int"))

    sliced = limits.withColumn("slice", F.explode(numbers))
    last_slice = (F.col("slice") == n - 1) | (first >= last)
    return sliced.withColumn(
        "slice_start", F.when(first < last, at(F.col("slice"))).otherwise(first)
    ).withColumn("slice_end", F.when(last_slice, last).otherwise(at(F.col("slice") + 1)))
