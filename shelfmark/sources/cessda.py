"""CESSDA: studies hosted elsewhere, so one placeholder file per study."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import once
from shelfmark.sources.landing import (
    Harvest,
    as_records,
    first_items,
    is_json,
    or_default,
    parse,
    people,
    search_items,
    slim_hits,
)

# The placeholder entry.
NOTICE_FILE = "EXTERNAL_REPOSITORY_NOTICE.txt"
CATALOGUE = "https://datacatalogue.cessda.eu"
NOTICE = "Study hosted externally. Resource access: "

_PAGE = "Results array<string>"
_STUDY = """
    titleStudy string, abstract string, keywords array<struct<term string>>,
    creators array<string>, studyUrl string, studyXmlSourceUrl string, dataAccess string
"""


def read_cessda(landing: DataFrame, source: str = "cessda") -> Harvest:
    items = search_items(
        landing, source, parse(F.col("body"), _PAGE)["Results"], F.get_json_object("item", "$.id")
    )
    study = F.col("s")
    title = or_default(study["titleStudy"], "")
    abstract = or_default(study["abstract"], "")
    url = F.coalesce(study["studyUrl"], study["studyXmlSourceUrl"], F.lit(""))
    keywords = F.filter(
        F.transform(study["keywords"], lambda k: k["term"]), lambda t: t.isNotNull()
    )
    names = F.transform(
        study["creators"], lambda c: F.when(is_json(c, "{"), F.get_json_object(c, "$.name")).otherwise(c)
    )
    persons = people(names, None)
    notice = F.struct(
        F.lit(NOTICE_FILE).alias("file_key"),
        F.lit(CATALOGUE).alias("file_url"),
        F.lit(None).cast("int").alias("tier"),
        F.lit(None).cast("boolean").alias("is_qda"),
        F.lit(None).cast("boolean").alias("is_required_qda"),
        F.lit(True).alias("restricted"),
        F.concat(F.lit(NOTICE), url).alias("failure_reason"),
    )
    records = once(first_items(items), s=parse(F.col("item"), _STUDY)).select(
        "recid",
        title.alias("title"),
        abstract.alias("description"),
        F.when(F.col("recid").startswith("doi:"), F.col("recid")).otherwise("").alias("doi"),
        or_default(F.array_join(F.transform(persons, lambda p: p["name"]), " | "), "").alias("creators_text"),
        persons.alias("persons"),
        or_default(study["dataAccess"], "CESSDA-External-Terms").alias("license_id"),
        url.alias("project_url"),
        F.array(notice).alias("files"),
        F.col("recid").alias("project_identifier"),
        F.col("item").alias("record_raw"),
        F.concat_ws(" ", title, abstract, F.array_join(keywords, " ")).alias("score_text"),
    )
    return Harvest(slim_hits(items), as_records(records, source))
