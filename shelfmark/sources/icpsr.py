"""ICPSR: study list embedded as JSON in a result page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.dates import date_part
from shelfmark.functions.once import once
from shelfmark.functions.text import project_identifier
from shelfmark.sources.landing import (
    Harvest,
    as_records,
    entry,
    first_items,
    or_default,
    parse,
    search_items,
    slim_hits,
)

STUDY_URL = "https://www.icpsr.umich.edu/web/ICPSR/studies/"

# Fixed value: where the page script carries the result list.
_BLOCK = r"(?s)searchResults\s*:\s*(\{.*?\})\s*,\s*searchConfig"
_RESPONSE = "response struct<numFound bigint, docs array<string>>"
_STUDY = """
    TITLE string, SUMMARY array<string>, DESCRIPTION array<string>, NOTES array<string>,
    AUTHOR array<string>, DATEUPDATED string, URL string
"""


def embedded_json(html: Column, pattern: str = _BLOCK) -> Column:
    """The JSON block of a page, null without one."""
    block = F.regexp_extract(html, pattern, 1)
    return F.when(block != "", block)


def read_icpsr(landing: DataFrame, source: str = "icpsr") -> Harvest:
    docs = parse(embedded_json(F.col("body")), _RESPONSE)["response"]["docs"]
    study_id = F.coalesce(F.get_json_object("item", "$.ID"), F.get_json_object("item", "$.STUDYQ"))
    items = search_items(landing, source, docs, study_id)
    study = F.col("s")
    none = F.array().cast("array<string>")
    blocks = F.concat(*[F.coalesce(study[f], none) for f in ("SUMMARY", "DESCRIPTION", "NOTES")])
    title = or_default(study["TITLE"], "Untitled Study")
    landing_url = F.coalesce(
        F.when(study["URL"] != "", study["URL"]), F.concat(F.lit(STUDY_URL), "recid")
    )
    records = once(first_items(items), s=parse(F.col("item"), _STUDY)).select(
        "recid",
        title.alias("title"),
        or_default(F.array_join(study["AUTHOR"], ", "), "").alias("creators_text"),
        F.lit("restricted").alias("license_id"),
        or_default(date_part(study["DATEUPDATED"]), "").alias("upload_date"),
        F.array(
            entry(landing_url, landing_url, tier=F.lit(2)).withField("is_qda", F.lit(False))
        ).alias("files"),
        project_identifier(title, F.col("recid")).alias("project_identifier"),
        F.col("item").alias("record_raw"),
        F.concat_ws(" ", title, F.array_join(blocks, " ")).alias("score_text"),
    )
    return Harvest(slim_hits(items), as_records(records, source))
