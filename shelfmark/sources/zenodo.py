"""Zenodo: search page -> record detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.files import file_ext
from shelfmark.functions.once import once
from shelfmark.functions.text import project_identifier
from shelfmark.operators.filters import is_administrative, recent
from shelfmark.sources.landing import (
    Harvest,
    as_records,
    by_key,
    entry,
    is_json,
    or_default,
    parse,
    people,
    search_items,
    slim_hits,
)
from shelfmark.taxonomy import ZENODO_TIER1_EXT

_PAGE = "hits struct<hits array<string>>"
_DETAIL = """
    id string, recid string, files string, links struct<html string>,
    metadata struct<
        title string, description string, doi string, language string,
        publication_date string, version string, license string,
        keywords array<string>,
        creators array<struct<name string, person_or_org struct<name string>>>>
"""
_FILE = "struct<key string, filename string, href string, links struct<self string, content string>>"


def _file_list(files: Column) -> Column:
    """``files`` is a list, an object with a list of entries, or a map of files."""
    entries = F.get_json_object(files, "$.entries")
    mapped = F.transform(
        F.map_values(F.from_json(files, "map<string, string>")),
        lambda v: F.when(is_json(v, "{"), F.from_json(v, _FILE)),
    )
    return (
        F.when(is_json(files, "["), F.from_json(files, f"array<{_FILE}>"))
        .when(
            is_json(entries, "[") & (F.json_array_length(entries) > 0),
            F.from_json(entries, f"array<{_FILE}>"),
        )
        .otherwise(mapped)
    )


def _filled(*choices: Column) -> Column:
    return F.coalesce(*[F.when(c != "", c) for c in choices], F.lit(""))


def _entries(files: Column) -> Column:
    named = F.transform(
        F.filter(files, lambda f: f.isNotNull()),
        lambda f: F.struct(
            _filled(f["key"], f["filename"]).alias("name"),
            _filled(f["links"]["self"], f["links"]["content"], f["href"]).alias("url"),
        ),
    )
    kept = F.filter(
        named, lambda f: (f["name"] != "") & (f["url"] != "") & ~is_administrative(f["name"])
    )
    tier = lambda name: F.when(file_ext(name).isin(ZENODO_TIER1_EXT), 1).otherwise(2)
    return F.transform(kept, lambda f: entry(f["name"], f["url"], tier=tier(f["name"])))


def recent_open(harvest: Harvest, run_date: str, days: int = 30) -> Harvest:
    """Records created in the last ``days`` days before ``run_date`` whose access is open."""
    raw = F.col("record_raw")
    created = F.substring(F.get_json_object(raw, "$.created"), 1, 10)
    access = F.coalesce(
        F.get_json_object(raw, "$.metadata.access_right"),
        F.get_json_object(raw, "$.metadata.access.record"),
    )
    kept = recent(created, F.to_date(F.lit(run_date)), days) & (F.lower(access) == "open")
    return harvest._replace(records=harvest.records.filter(kept))


def read_zenodo(landing: DataFrame, source: str = "zenodo") -> Harvest:
    items = search_items(
        landing, source, parse(F.col("body"), _PAGE)["hits"]["hits"], F.get_json_object("item", "$.id")
    )
    detail = once(
        by_key(landing, "detail").withColumnRenamed("key", "recid"),
        d=parse(F.col("body"), _DETAIL),
    )
    meta = F.col("d.metadata")
    names = F.transform(
        meta["creators"], lambda c: _filled(c["name"], c["person_or_org"]["name"])
    )
    records = detail.filter(F.col("d").isNotNull()).select(
        "recid",
        or_default(meta["title"], "Untitled").alias("title"),
        or_default(meta["description"], "").alias("description"),
        or_default(meta["doi"], "").alias("doi"),
        or_default(meta["language"], "").alias("language"),
        or_default(meta["publication_date"], "").alias("upload_date"),
        or_default(meta["version"], "v1").alias("version"),
        F.coalesce(F.get_json_object(meta["license"], "$.id"), meta["license"]).alias("license"),
        F.coalesce(meta["keywords"], F.array().cast("array<string>")).alias("keywords"),
        people(names, "AUTHOR").alias("creators"),
        F.coalesce(
            F.col("d.links.html"), F.concat(F.lit("https://zenodo.org/records/"), "recid")
        ).alias("project_url"),
        F.lit("https://zenodo.org").alias("repository_url"),
        _entries(_file_list(F.col("d.files"))).alias("files"),
        F.col("body").alias("record_raw"),
        F.concat_ws(
            " ", or_default(meta["title"], ""), or_default(meta["description"], "")
        ).alias("score_text"),
    )
    records = records.withColumn(
        "project_identifier", project_identifier(F.col("title"), F.col("recid"), None)
    )
    return Harvest(slim_hits(items), as_records(records, source))
