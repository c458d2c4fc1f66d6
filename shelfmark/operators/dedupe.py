"""Duplicates: first arrival, best copy, file URLs seen before.

All of them aggregate with a partial step before the shuffle, so one id that
fills a third of the rows still sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ["term_rank", "page", "pos"]


def first_rows(
    df: DataFrame, key: Sequence[str], order: Sequence[str], where: Column | None = None
) -> DataFrame:
    """The first row of every key by ``order``, out of the rows ``where`` holds."""
    if where is not None:
        df = df.filter(where)
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*key, "_first.*").select(*df.columns)


def first_accepted(
    df: DataFrame, key: Sequence[str], accept: Column, order: Sequence[str] = ORDER
) -> DataFrame:
    """First arrival that passes: an id rejected under one term gets another try."""
    return first_rows(df, key, order, where=F.coalesce(accept, F.lit(False)))


def first_seen(
    df: DataFrame, key: Sequence[str], accept: Column, order: Sequence[str] = ORDER
) -> DataFrame:
    """First arrival, if it passes: a rejected id never comes back."""
    return first_rows(df, key, order).filter(F.coalesce(accept, F.lit(False)))


def best_versions(
    df: DataFrame, key: Sequence[str], id_col: str, prefer: Sequence[tuple[str, Column]]
) -> DataFrame:
    """The best copy of every group: ``prefer`` lists (name, rank), low is better,
    the id breaks ties. Returns ``key``, the kept id and the group size; rows of
    the kept copies come from a semi join on the id."""
    ranked = df.select(*key, id_col, *[rank.alias(name) for name, rank in prefer])
    order = F.struct(*[name for name, _ in prefer], id_col)
    return ranked.groupBy(*key).agg(
        F.min_by(id_col, order).alias(id_col), F.count(F.lit(1)).alias("n_versions")
    )


def fresh_file_urls(
    records: DataFrame, record_key: Sequence[str], order: Sequence[str], files: str = "files"
) -> DataFrame:
    """Keep each file with the first record that lists its URL; drop records left
    without a file. A URL listed twice by its first record stays twice.

    The owner of a URL is found by an aggregate and matched back on (URL,
    record), so a URL that half of all records share is no hot join key.
    """
    entries = records.select(*record_key, *order, F.posexplode(files).alias("_at", "_file"))
    entries = entries.withColumn("_url", F.col("_file.file_url"))
    owners = (
        entries.groupBy("_url")
        .agg(F.min(F.struct(*order, *record_key)).alias("_owner"))
        .select("_url", *[F.col(f"_owner.{c}").alias(c) for c in record_key])
    )
    # a record's own list bounds what is collected back for it
    kept = (
        entries.join(owners, ["_url", *record_key], "left_semi")
        .groupBy(*record_key)
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_file"))).alias("_kept"))
        .select(*record_key, F.expr("transform(_kept, k -> k._file)").alias(files))
    )
    return records.drop(files).join(kept, list(record_key)).select(*records.columns)


def unseen(df: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known``. The keys are reduced first; Spark
    broadcasts them when their size allows and merges sorted keys otherwise."""
    return df.join(known.select(*key).distinct(), list(key), "left_anti")
