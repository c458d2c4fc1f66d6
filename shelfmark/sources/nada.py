"""NADA catalogs (IHSN, DataFirst): row -> detail, with or without resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import once
from shelfmark.functions.text import project_identifier
from shelfmark.sources.landing import (
    Harvest,
    as_records,
    by_key,
    entry,
    first_items,
    is_object,
    or_default,
    parse,
    search_items,
    slim_hits,
)
from shelfmark.taxonomy import NADA_LICENSES

_PAGE = "result struct<rows array<string>>"
_ROW = "title string, subtitle string, nation string"
_DETAIL = """
    dataset struct<title string, subtitle string, abstract string, description string,
        study_notes string,
        metadata struct<doc_desc struct<producers array<struct<name string, role string>>>>>
"""
_RESOURCES = "resources array<struct<title string, filename string, url string>>"


def _name(resource: Column) -> Column:
    return F.coalesce(
        F.when(resource["filename"] != "", resource["filename"]), resource["title"]
    )


def _entries(resources: Column) -> Column:
    built = F.transform(resources, lambda r: entry(_name(r), r["url"]))
    return F.filter(
        built, lambda e: (e["file_key"] != "") & (e["file_url"] != "") & (e["tier"] > 0)
    )


def read_nada(landing: DataFrame, source: str) -> Harvest:
    items = search_items(
        landing,
        source,
        parse(F.col("body"), _PAGE)["result"]["rows"],
        F.get_json_object("item", "$.idno"),
    )
    rows = once(first_items(items), r=parse(F.col("item"), _ROW)).drop("item")
    detail = once(
        by_key(landing, "detail").withColumnRenamed("key", "recid").filter(is_object(F.col("body"))),
        d=parse(F.col("body"), _DETAIL)["dataset"],
    )
    resources = once(
        by_key(landing, "resources").withColumnRenamed("key", "recid"),
        res=parse(F.col("body"), _RESOURCES)["resources"],
    ).drop("body")
    none = F.array().cast("array<struct<title string, filename string, url string>>")
    joined = (
        rows.join(detail, "recid")
        .join(resources, "recid", "left")
        .withColumn("res", F.coalesce("res", none))
    )
    producers = F.transform(
        F.col("d.metadata.doc_desc.producers"),
        lambda p: F.struct(
            or_default(p["name"], "").alias("name"),
            or_default(p["role"], "PRODUCER").alias("role"),
        ),
    )
    title = or_default(F.col("r.title"), "Untitled Study")
    resource_texts = F.flatten(
        F.transform("res", lambda r: F.array(r["title"], r["filename"]))
    )
    blocks = F.concat(
        F.array(
            *[F.col(f"r.{c}") for c in ("title", "subtitle", "nation")],
            *[
                F.col(f"d.{c}")
                for c in ("title", "subtitle", "abstract", "description", "study_notes")
            ],
        ),
        resource_texts,
    )
    records = joined.select(
        "recid",
        title.alias("title"),
        F.coalesce(F.when(F.col("r.subtitle") != "", F.col("r.subtitle")), title).alias("description"),
        F.lit(NADA_LICENSES[source]).alias("license_id"),
        or_default(
            F.array_join(
                F.transform(F.filter(producers, lambda p: p["name"] != ""), lambda p: p["name"]),
                " | ",
            ),
            "",
        ).alias("creators_text"),
        producers.alias("persons"),
        _entries(F.col("res")).alias("files"),
        project_identifier(
            title, F.substring(F.replace("recid", F.lit("/"), F.lit("-")), 1, 80)
        ).alias("project_identifier"),
        F.col("body").alias("record_raw"),
        F.array_join(F.filter(blocks, lambda b: b != ""), " ").alias("score_text"),
    )
    return Harvest(slim_hits(items), as_records(records, source))
