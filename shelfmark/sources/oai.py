"""OAI-PMH list responses in Dublin Core or DataCite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.files import link_file_name
from shelfmark.functions.once import once
from shelfmark.functions.text import slugify, strip
from shelfmark.session import stored
from shelfmark.sources.landing import Harvest, as_records, entry, of_kind, or_default, slim_hits

_DC = """struct<title array<string>, creator array<string>, rights array<string>,
    identifier array<string>, relation array<string>, source array<string>,
    description array<string>, subject array<string>>"""
_DATACITE = """struct<identifier array<string>, titles struct<title array<string>>,
    creators struct<creator array<struct<creatorName string>>>,
    rightsList struct<rights array<string>>,
    alternateIdentifiers struct<alternateIdentifier array<string>>,
    relatedIdentifiers struct<relatedIdentifier array<string>>,
    descriptions struct<description array<string>>,
    subjects struct<subject array<string>>>"""
_PAGE = f"""ListRecords struct<record array<struct<
    header struct<identifier string>,
    metadata struct<dc {_DC}, resource {_DATACITE},
        oai_datacite struct<payload struct<resource {_DATACITE}>>>>>>"""


def parse_records(landing: DataFrame) -> DataFrame:
    """One row per OAI record. A malformed response yields no record."""
    parsed = F.from_xml(
        F.col("body"), F.lit(_PAGE), {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
    )
    pages = of_kind(landing, "search").select(F.coalesce("page", F.lit(0)).alias("page"), "body")
    return (
        once(pages, _r=parsed["ListRecords"]["record"])
        .select("page", F.posexplode("_r").alias("pos", "record"))
        .select(
            strip(or_default(F.col("record.header.identifier"), "")).alias("recid"),
            "page", "pos", F.col("record.metadata").alias("metadata"),
        )
    )


def _dublin_core(meta: Column) -> dict[str, Column]:
    dc = meta["dc"]
    return {
        "title": dc["title"],
        "creators": dc["creator"],
        "rights": dc["rights"],
        "links": [dc["identifier"], dc["relation"], dc["source"]],
        "text": [dc["title"], dc["description"], dc["subject"]],
    }


def _datacite(meta: Column) -> dict[str, Column]:
    res = F.coalesce(meta["resource"], meta["oai_datacite"]["payload"]["resource"])
    return {
        "title": res["titles"]["title"],
        "creators": F.transform(res["creators"]["creator"], lambda c: c["creatorName"]),
        "rights": res["rightsList"]["rights"],
        "links": [
            res["identifier"],
            res["alternateIdentifiers"]["alternateIdentifier"],
            res["relatedIdentifiers"]["relatedIdentifier"],
        ],
        "text": [
            res["titles"]["title"],
            res["descriptions"]["description"],
            res["subjects"]["subject"],
        ],
    }


def _texts(*arrays: Column) -> Column:
    none = F.array().cast("array<string>")
    joined = F.concat(*[F.coalesce(a, none) for a in arrays])
    trimmed = F.transform(joined, strip)
    return F.filter(trimmed, lambda t: t != "")


def file_entries(links: Column) -> Column:
    """Entries for http links whose file name has a known extension."""
    urls = F.filter(links, lambda u: u.startswith("http"))
    built = F.transform(urls, lambda u: entry(link_file_name(u), u))
    return F.filter(built, lambda e: e["tier"] > 0)


def read_oai(
    landing: DataFrame, source: str, prefix: str = "oai_datacite", short_slugs: bool = False
) -> Harvest:
    """``short_slugs`` builds the identifier from two slugs of at most 40 characters."""
    # the places and the records both come from here; the XML is parsed once
    records = stored(parse_records(landing).filter(F.col("recid") != ""), "oai")
    hits = records.withColumns(
        {
            "context_repository": F.lit(source),
            "term": F.lit(None).cast("string"),
            "term_rank": F.lit(0),
        }
    )
    fields = (_dublin_core if prefix == "oai_dc" else _datacite)(F.col("metadata"))
    title = or_default(F.try_element_at(_texts(fields["title"]), F.lit(1)), "untitled_project")
    if short_slugs:
        slug = slugify(title, 40, "untitled")
        slug_id = slugify(F.col("recid"), 40, "untitled")
    else:
        slug = slugify(title)
        slug_id = F.substring(slugify(F.col("recid")), 1, 40)
    conformed = records.groupBy("recid").agg(
        F.max_by("metadata", F.struct("page", "pos")).alias("metadata")
    ).select(
        "recid",
        title.alias("title"),
        F.array_join(_texts(fields["creators"]), " | ").alias("creators_text"),
        F.try_element_at(_texts(fields["rights"]), F.lit(1)).alias("license_id"),
        file_entries(_texts(*fields["links"])).alias("files"),
        F.substring(F.concat(slug, F.lit("-"), slug_id), 1, 120).alias("project_identifier"),
        F.to_json(F.struct(F.col("recid").alias("oai_id"))).alias("record_raw"),
        F.array_join(_texts(*fields["text"]), " ").alias("score_text"),
    )
    return Harvest(slim_hits(hits), as_records(conformed, source))
