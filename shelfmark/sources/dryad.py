"""Dryad: dataset -> version -> files, linked by hrefs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.files import absolute_href
from shelfmark.functions.once import once
from shelfmark.functions.records import format_authors, map_license
from shelfmark.functions.text import project_identifier
from shelfmark.sources.landing import (
    Harvest,
    as_records,
    by_key,
    entry,
    first_items,
    or_default,
    parse,
    search_items,
    slim_hits,
)

HOST = "https://datadryad.org"

_PAGE = "_embedded struct<`stash:datasets` array<string>>"
_DATASET = """
    title string, abstract string, license string,
    _links struct<`stash:version` struct<href string>>
"""
_VERSION = """
    title string, license string, authors array<struct<firstName string, lastName string>>,
    _links struct<`stash:files` struct<href string>>
"""
_FILES = """
    _embedded struct<`stash:files` array<struct<path string, name string,
        _links struct<`stash:download` struct<href string>, download string>,
        links struct<`stash:download` struct<href string>, download string>>>>
"""


def _filled(*choices: Column) -> Column:
    return F.coalesce(*[F.when(c != "", c) for c in choices])


def _entries(files: Column) -> Column:
    def resolved(f: Column) -> Column:
        links = F.coalesce(f["_links"], f["links"])
        href = _filled(links["stash:download"]["href"], links["download"])
        path = _filled(f["path"], f["name"])
        built = entry(path, absolute_href(href, HOST))
        # tier and flags come from the whole path, the name is its last part
        return built.withField("file_key", F.substring_index(path, "/", -1))

    return F.filter(
        F.transform(files, resolved),
        lambda e: e["file_key"].isNotNull() & e["file_url"].isNotNull() & (e["tier"] > 0),
    )


def read_dryad(landing: DataFrame, source: str = "dryad") -> Harvest:
    item_id = F.coalesce(
        F.when(F.get_json_object("item", "$.identifier") != "", F.get_json_object("item", "$.identifier")),
        F.get_json_object("item", "$.id"),
    )
    items = search_items(
        landing, source, parse(F.col("body"), _PAGE)["_embedded"]["stash:datasets"], item_id
    )
    datasets = once(first_items(items), ds=parse(F.col("item"), _DATASET)).withColumn("version_href", absolute_href(F.col("ds._links")["stash:version"]["href"], HOST))
    versions = once(
        by_key(landing, "version").withColumnRenamed("key", "version_href"),
        v=parse(F.col("body"), _VERSION),
    ).drop("body").withColumn("files_href", absolute_href(F.col("v._links")["stash:files"]["href"], HOST))
    files = once(
        by_key(landing, "files").withColumnRenamed("key", "files_href"),
        files=_entries(parse(F.col("body"), _FILES)["_embedded"]["stash:files"]),
    ).drop("body")
    title = F.coalesce(F.col("v.title"), F.col("ds.title"), F.lit("Untitled"))
    license = F.coalesce(F.when(F.col("ds.license") != "", F.col("ds.license")), F.col("v.license"))
    short_id = F.substring(
        F.replace(F.replace("recid", F.lit("doi:"), F.lit("")), F.lit("/"), F.lit("-")), 1, 50
    )
    records = (
        datasets.join(versions, "version_href")
        .join(files, "files_href")
        .select(
            "recid",
            title.alias("title"),
            format_authors(F.col("v.authors")).alias("creators_text"),
            or_default(map_license(license), "cc0").alias("license_id"),
            "files",
            project_identifier(title, short_id).alias("project_identifier"),
            F.to_json(F.struct(F.col("item").alias("dataset"), F.to_json("v").alias("version"))).alias("record_raw"),
            F.concat_ws(
                " ", or_default(F.col("ds.title"), ""), or_default(F.col("ds.abstract"), "")
            ).alias("score_text"),
        )
    )
    return Harvest(slim_hits(items), as_records(records, source))
