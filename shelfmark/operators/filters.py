"""Filters on candidate records and their file arrays."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.files import base_name, file_ext, is_project_file
from shelfmark.functions.records import is_open_license
from shelfmark.taxonomy import FILE_TYPES, RELEVANCE_THRESHOLD, FileTypes

# Names of files a repository adds by itself.
WEB_FILES = ["article.html", "abstract", "summary.pdf"]
WEB_FILE_PARTS = ["index.html"]
MIGRATION_FILE_PARTS = ["easy-migration.zip", "manifest"]


def passes(score: Column, is_strict: Column, threshold: int = RELEVANCE_THRESHOLD) -> Column:
    """A strict search term vouches for its hits; others need the score."""
    return F.coalesce(is_strict, F.lit(False)) | (score >= threshold)


def recent(created: Column, run_date: dt.date | Column, days: int = 30) -> Column:
    """Created within the last ``days`` days of ``run_date``, both ends in."""
    end = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return created.cast("date").between(F.date_sub(end, days), end)


def open_license(df: DataFrame, license: str = "license") -> DataFrame:
    return df.filter(is_open_license(F.col(license)))


def is_administrative(
    name: Column, names: Sequence[str] = WEB_FILES, parts: Sequence[str] = WEB_FILE_PARTS
) -> Column:
    low = F.lower(name)
    hit = low.isin(list(names)) if names else F.lit(False)
    for part in parts:
        hit = hit | F.contains(low, F.lit(part))
    return hit


def usable_files(files: Column) -> Column:
    """Entries that have a name and either a URL or a restriction."""
    return F.filter(
        files,
        lambda f: (f["file_key"] != "")
        & (F.coalesce(f["restricted"], F.lit(False)) | (F.coalesce(f["file_url"], F.lit("")) != "")),
    )


def with_files(df: DataFrame, files: str = "files") -> DataFrame:
    """Records with at least one entry."""
    return df.filter(F.size(files) > 0)


def split_restricted(files: DataFrame, restricted: str = "restricted") -> tuple[DataFrame, DataFrame]:
    """(accessible, restricted) file rows; an unset flag means accessible."""
    flag = F.coalesce(F.col(restricted), F.lit(False))
    return files.filter(~flag), files.filter(flag)


def project_files_only(
    files: DataFrame, name: str = "file_name", types: FileTypes = FILE_TYPES
) -> DataFrame:
    """Strict mode: only analysis-project files, and so only projects with one."""
    return files.filter(is_project_file(file_ext(base_name(F.col(name))), types))


def strict_records(
    records: DataFrame, files: str = "files", types: FileTypes = FILE_TYPES
) -> DataFrame:
    """Strict mode on records that carry their files as an array."""
    kept = F.filter(files, lambda f: is_project_file(file_ext(base_name(f["file_key"])), types))
    return with_files(records.withColumn(files, kept), files)
