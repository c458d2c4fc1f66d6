"""Dataverse family: search item -> dataset detail by global id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.files import file_ext, file_tier
from shelfmark.functions.once import once
from shelfmark.functions.records import failure_reason
from shelfmark.functions.text import project_identifier
from shelfmark.operators.filters import MIGRATION_FILE_PARTS, is_administrative
from shelfmark.sources.landing import (
    Harvest,
    as_records,
    by_key,
    entry,
    first_items,
    is_json,
    or_default,
    parse,
    people,
    search_items,
    slim_hits,
)
from shelfmark.taxonomy import DATAVERSE_HOSTS

_PAGE = "data struct<items array<string>>"
_ITEM = """
    name string, description string, authors array<string>,
    license_url string, published_at string
"""
_DETAIL = """
    data struct<latestVersion struct<files array<struct<
        restricted boolean, embargoDate string, label string,
        dataFile struct<id string, filename string>>>>>
"""


def _entries(files: Column, host: str) -> Column:
    def named(f: Column) -> Column:
        return F.struct(
            F.coalesce(
                F.when(f["dataFile"]["filename"] != "", f["dataFile"]["filename"]),
                F.when(f["label"] != "", f["label"]),
                F.lit("unknown_file"),
            ).alias("name"),
            f["dataFile"]["id"].alias("id"),
            F.coalesce(f["restricted"], F.lit(False)).alias("restricted"),
            f["embargoDate"].alias("embargo"),
        )

    kept = F.filter(
        F.transform(files, named),
        lambda f: ~is_administrative(f["name"], [], MIGRATION_FILE_PARTS)
        & (f["restricted"] | F.coalesce(f["id"] != "0", F.lit(False))),
    )

    def built(f: Column) -> Column:
        tier = file_tier(file_ext(f["name"]))
        return entry(
            f["name"],
            F.when(f["restricted"], "").otherwise(
                F.concat(F.lit(f"{host}/api/access/datafile/"), f["id"])
            ),
            tier=F.when(tier > 0, tier).otherwise(2),
            restricted=f["restricted"],
            reason=F.when(f["restricted"], failure_reason(f["embargo"])),
        )

    return F.transform(kept, built)


def read_dataverse(landing: DataFrame, source: str, host: str | None = None) -> Harvest:
    host = (host or DATAVERSE_HOSTS[source]).rstrip("/")
    items = search_items(
        landing,
        source,
        parse(F.col("body"), _PAGE)["data"]["items"],
        F.get_json_object("item", "$.global_id"),
    )
    listed = once(first_items(items), i=parse(F.col("item"), _ITEM))
    # an answer without ``data`` or ``latestVersion`` stands for an empty file list
    detail = once(
        by_key(landing, "detail").withColumnRenamed("key", "recid"),
        data=parse(F.col("body"), _DETAIL)["data"],
    ).drop("body").filter(F.col("data").isNotNull())
    raw = F.col("i.description")
    description = F.when(
        is_json(raw, "[") & F.from_json(raw, "array<string>").isNotNull(),
        F.array_join(F.from_json(raw, "array<string>"), " "),
    ).otherwise(raw)
    title = or_default(F.col("i.name"), "")
    # an author is an object with a name; plain strings are not people here
    names = F.transform(
        F.filter(F.col("i.authors"), lambda a: is_json(a, "{")),
        lambda a: F.get_json_object(a, "$.name"),
    )
    safe_id = F.translate("recid", "/:", "--")
    records = listed.join(detail, "recid").select(
        "recid",
        title.alias("title"),
        or_default(description, "").alias("description"),
        F.col("recid").alias("doi"),
        people(names, "AUTHOR").alias("creators"),
        F.concat(F.lit(f"{host}/dataset.xhtml?persistentId="), "recid").alias("project_url"),
        F.lit(host).alias("repository_url"),
        or_default(F.col("i.license_url"), "").alias("license"),
        or_default(F.col("i.published_at"), "").alias("upload_date"),
        _entries(F.col("data.latestVersion.files"), host).alias("files"),
        project_identifier(title, safe_id).alias("project_identifier"),
        F.col("item").alias("record_raw"),
        F.concat_ws(" ", title, or_default(description, "")).alias("score_text"),
    )
    return Harvest(slim_hits(items), as_records(records, source))
