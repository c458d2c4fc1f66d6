"""Landed responses and what the readers share.

A reader turns responses into a :class:`Harvest`:

* ``hits``: which record turned up under which term, and where. Ids only.
* ``records``: every record once, conformed, with its files and its score text.

Keeping the two apart means that a record found under a hundred terms is parsed,
scored and shuffled once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.files import file_ext, file_tier, is_project_file, is_required_file
from shelfmark.functions.once import once
from shelfmark.operators.joins import latest_by_key
from shelfmark.schemas import HITS, LANDING, RECORD, conform


class Harvest(NamedTuple):
    hits: DataFrame
    records: DataFrame


def read_landing(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Responses below ``path`` (parquet or JSON lines). Partition the folder by
    ``kind``: readers pick kinds, and Spark then opens those folders only."""
    return conform(spark.read.schema(LANDING).format(format).load(path), LANDING)


def of_kind(landing: DataFrame, kind: str) -> DataFrame:
    return landing.filter(F.col("kind") == kind)


def by_key(landing: DataFrame, kind: str) -> DataFrame:
    """(key, body) of the last response for every key."""
    rows = of_kind(landing, kind).select("key", "seq", "body")
    return latest_by_key(rows, ["key"], "seq").select("key", "body")


def parse(body: Column, schema: str) -> Column:
    """JSON by an explicit schema. A field that is sometimes an object and
    sometimes a string is declared STRING and arrives as its JSON text."""
    return F.from_json(body, schema)


def is_object(body: Column) -> Column:
    """Whether a response is a JSON object at all."""
    return F.json_object_keys(body).isNotNull()


def is_json(text: Column, opening: str) -> Column:
    return F.ltrim(text).startswith(opening)


def or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def search_items(landing: DataFrame, source: str, items: Column, item_id: Column) -> DataFrame:
    """Every listed item with its place: ``HITS`` columns + ``item`` (JSON text)."""
    listed = of_kind(landing, "search").select(
        "term", "term_rank", "page", F.posexplode(items).alias("pos", "item")
    )
    return once(listed, recid=item_id).select(
        F.lit(source).alias("context_repository"),
        "recid", "term", "term_rank", "page", "pos", "item",
    ).filter(F.col("recid") != "")


def slim_hits(items: DataFrame) -> DataFrame:
    return conform(items, HITS)


def first_items(items: DataFrame) -> DataFrame:
    """(recid, item) of every record, from the first place it was listed."""
    at = F.struct("term_rank", "page", "pos")
    return items.groupBy("recid").agg(F.min_by("item", at).alias("item"))


def entry(
    key: Column,
    url: Column,
    tier: Column | None = None,
    restricted: Column | None = None,
    reason: Column | None = None,
) -> Column:
    """A file entry; flags follow from the extension of its name."""
    ext = file_ext(key)
    return F.struct(
        key.alias("file_key"),
        url.alias("file_url"),
        (file_tier(ext) if tier is None else tier).cast("int").alias("tier"),
        is_project_file(ext).alias("is_qda"),
        is_required_file(ext).alias("is_required_qda"),
        (F.lit(False) if restricted is None else restricted).alias("restricted"),
        (F.lit(None) if reason is None else reason).cast("string").alias("failure_reason"),
    )


def people(names: Column, role: str | None) -> Column:
    """Structs (name, role) out of an array of names, unnamed ones dropped."""
    named = F.filter(names, lambda n: n != "")
    return F.transform(
        named, lambda n: F.struct(n.alias("name"), F.lit(role).cast("string").alias("role"))
    )


def as_records(df: DataFrame, source: str) -> DataFrame:
    df = once(df, files=F.col("files"))
    return conform(df.withColumn("context_repository", F.lit(source)), RECORD)
