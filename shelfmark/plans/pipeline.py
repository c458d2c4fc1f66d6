"""The whole run: landed responses of several sources to the next snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans.acquire import Search, accept, policy_for, searched
from shelfmark.plans.tables import (
    Arrivals,
    Tables,
    arrivals,
    merge_folded,
    place,
    read_tables,
    rejected_children,
    split_batch,
    write_all,
    write_tables,
)
from shelfmark.session import stored
from shelfmark.sources.registry import read_source


def acquire(
    spark: SparkSession,
    landing: str,
    sources: Sequence[str],
    max_records: int | None = None,
    user_query: bool = False,
    format: str = "parquet",
    search: Search | None = None,
) -> DataFrame:
    """Accepted records of all sources; ``landing`` has one folder per source. With a
    ``search`` only what it asks a source for counts, of all that has landed."""
    accepted = []
    for source in sources:
        policy = policy_for(source, user_query or bool(search and search.query))
        harvest = read_source(spark, source, f"{landing}/{source}", format)
        if search:
            harvest = searched(harvest, source, search)
        accepted.append(accept(harvest, policy, max_records, store=stored))
    return reduce(DataFrame.unionByName, accepted)


def merge_into(current: Tables, arrived: Arrivals, folder: str) -> None:
    """Merge arrivals into ``current`` and write the result as snapshot ``folder``.

    The places of the projects feed all writes, so they are stored before them. Rows that
    lack a required column go to ``quarantine``, those of children as well.
    """
    folded, rejected = split_batch(arrived)
    placed = place(current.projects, folded, stored)
    bad = {"projects": rejected, **rejected_children(placed, arrived)}
    write_all({f"{folder}/quarantine/{name}": rows for name, rows in bad.items()}, "append")
    write_tables(merge_folded(current, folded, arrived, placed), folder)


def run(
    spark: SparkSession,
    landing: str,
    sources: Sequence[str],
    outcomes: DataFrame,
    tables: str,
    next_tables: str,
    download_date: str,
    members: DataFrame | None = None,
    strict: bool = False,
    **acquire_options: object,
) -> Tables:
    """Landing to snapshot ``next_tables``, starting from snapshot ``tables``."""
    accepted = stored(acquire(spark, landing, sources, **acquire_options))
    arrived = arrivals(accepted, outcomes, download_date, members, strict, store=stored)
    merge_into(read_tables(spark, tables), arrived, next_tables)
    return read_tables(spark, next_tables)
