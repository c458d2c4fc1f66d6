"""The cleaning run over a snapshot: one copy of each project, filled fields, whole links.

The best copies are chosen first; what is filled or repaired afterwards is filled for
them alone. Nothing is deleted in place: the result is written as the next snapshot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import null_if_blank
from shelfmark.operators.copies import copy_groups
from shelfmark.operators.dedupe import best_versions
from shelfmark.operators.joins import drop_orphans, ghost_folders, orphans
from shelfmark.operators.language import LanguageModel, fill_language_by_model
from shelfmark.operators.quality import (
    LINK_FILE,
    STOP_WORDS,
    external_link,
    fill_description,
    fill_language,
    repair_file_types,
)
from shelfmark.plans.tables import Tables
from shelfmark.session import stored
from shelfmark.taxonomy import AGGREGATORS

#: Titles that stand for a missing one; they say nothing about a copy.
NO_TITLES = ("untitled", "unknown title", "untitled study", "untitled project")


class Cleaned(NamedTuple):
    """The tables, and what was found on the way."""

    tables: Tables
    duplicates: DataFrame  # group, kept id, number of copies
    orphans: DataFrame  # table, project_id, number of rows
    ghosts: DataFrame | None  # folders without a transferred file


def title_key(title: Column) -> Column:
    """Letters and digits of a title in lower case; null where it says nothing."""
    plain = F.trim(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", " "))
    return F.when((plain != "") & ~plain.isin(*NO_TITLES), plain)


def doi_key(doi: Column) -> Column:
    """A DOI in lower case without its resolver; null where there is none."""
    return F.lower(null_if_blank(F.regexp_replace(doi, r"^(?i:https?://(?:dx\.)?doi\.org/|doi:)", "")))


def copy_key(projects: DataFrame) -> DataFrame:
    """Add ``_copy_of``: the title that copies share, else the DOI, else the row's own
    id. The three cannot meet, each carries its kind. A plain key for listings; copies
    are told by :func:`project_copies`."""
    return projects.withColumn(
        "_copy_of",
        F.coalesce(
            F.concat(F.lit("t:"), title_key(F.col("title"))),
            F.concat(F.lit("d:"), doi_key(F.col("doi"))),
            F.concat(F.lit("i:"), F.col("id").cast("string")),
        ),
    )


def _preferred(aggregators: Sequence[str]) -> list[tuple[str, Column]]:
    """A copy with a DOI comes first, then one from a repository that hosts it, then one
    from an aggregator."""
    mirrored = F.coalesce(F.col("download_repository_folder").isin(*aggregators), F.lit(False))
    return [("_no_doi", doi_key(F.col("doi")).isNull().cast("int")), ("_mirrored", mirrored.cast("int"))]


def best_of_title(projects: DataFrame, aggregators: Sequence[str] = AGGREGATORS) -> DataFrame:
    """``_copy_of, id, n_versions``: the best row of every :func:`copy_key`."""
    return best_versions(copy_key(projects), ["_copy_of"], "id", _preferred(aggregators))


def project_copies(projects: DataFrame) -> DataFrame:
    """``id, copy_of``: one DOI is one project, two DOIs are two; without one, rows that
    share a title or an address belong together (see ``operators.copies``)."""
    keys = {"title": title_key(F.col("title")), "url": null_if_blank(F.col("project_url"))}
    return copy_groups(projects, "id", doi_key(F.col("doi")), keys)


def best_copies(projects: DataFrame, aggregators: Sequence[str] = AGGREGATORS) -> DataFrame:
    """``copy_of, id, n_versions``: the best copy of every project."""
    named = projects.join(project_copies(projects).hint("merge"), "id")
    return best_versions(named, ["copy_of"], "id", _preferred(aggregators))


def link_files(files: DataFrame) -> DataFrame:
    """Placeholders of studies hosted elsewhere become links that count as there. The
    address stays in the row: it takes the place of the reason."""
    link = external_link(F.col("failure_reason"))
    return files.withColumns(
        {
            "file_name": F.when(link.isNotNull(), LINK_FILE).otherwise(F.col("file_name")),
            "status": F.when(link.isNotNull(), "SUCCEEDED").otherwise(F.col("status")),
            "failure_reason": F.coalesce(link, F.col("failure_reason")),
        }
    )


def _described(projects: DataFrame, keywords: DataFrame) -> DataFrame:
    """Missing descriptions from the title, then from the keywords. Only the keywords of
    projects without either are gathered."""
    bare = projects.where(null_if_blank(F.col("description")).isNull() & null_if_blank(F.col("title")).isNull())
    words = (
        keywords.join(bare.select(F.col("id").alias("project_id")), "project_id", "left_semi")
        .groupBy("project_id").agg(F.array_sort(F.collect_set("keyword")).alias("_keywords"))
        .withColumnRenamed("project_id", "id")
    )
    return fill_description(projects.join(words, "id", "left"), keywords="_keywords")


def clean(
    tables: Tables,
    folders: DataFrame | None = None,
    aggregators: Sequence[str] = AGGREGATORS,
    stop_words: Mapping[str, Sequence[str]] = STOP_WORDS,
    model: LanguageModel | None = None,
) -> Cleaned:
    """Best copies with their children, missing descriptions and languages filled (by a
    fitted ``model`` where one is given, else by stop words), link files and file types
    repaired. Orphans and, given the listed ``folders``, ghost
    folders are reported as the snapshot had them."""
    best = stored(best_copies(tables.projects, aggregators), "best")
    kept = tables.projects.join(best.select("id"), "id", "left_semi")
    described = _described(kept, tables.keywords)
    if model is None:
        filled = fill_language(described, stop_words=stop_words)
    else:
        filled = fill_language_by_model(described, model)
    filled = filled.select(*tables.projects.columns)
    lost = [
        orphans(rows, tables.projects).select(F.lit(name).alias("table_name"), "project_id", "n")
        for name, rows in tables._asdict().items() if name != "projects"
    ]
    return Cleaned(
        Tables(
            filled,
            repair_file_types(link_files(drop_orphans(tables.files, kept))),
            drop_orphans(tables.keywords, kept),
            drop_orphans(tables.person_role, kept),
        ),
        best,
        lost[0].unionByName(lost[1]).unionByName(lost[2]),
        None if folders is None else ghost_folders(folders, tables.projects, tables.files),
    )
