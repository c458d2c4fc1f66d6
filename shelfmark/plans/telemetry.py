"""Telemetry over the four tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.joins import child_counts



def succeeded(files: DataFrame) -> DataFrame:
    return files.filter(F.col("status") == "SUCCEEDED")


def totals(projects: DataFrame, files: DataFrame) -> DataFrame:
    """One row: succeeded files and distinct projects."""
    n_files = succeeded(files).agg(
        F.count(F.lit(1)).alias("total_files"), F.lit(0).cast("bigint").alias("total_projects")
    )
    n_projects = projects.agg(
        F.lit(0).cast("bigint").alias("total_files"),
        F.count_distinct("id").alias("total_projects"),
    )
    return n_files.unionByName(n_projects).agg(
        F.sum("total_files").alias("total_files"), F.sum("total_projects").alias("total_projects")
    )


def files_per_repository(
    projects: DataFrame, files: DataFrame, repository: str = "repository_url"
) -> DataFrame:
    """Succeeded files per repository, most first."""
    counted = child_counts(projects.select("id", repository), succeeded(files))
    return (
        counted.groupBy(repository)
        .agg(F.sum("n").alias("n_files"))
        .orderBy(F.desc("n_files"), repository)
    )


def _type_label(file_type: Column) -> Column:
    return F.coalesce(F.upper(F.when(file_type != "", file_type)), F.lit("UNKNOWN"))


def files_by_type(files: DataFrame, top: int | None = 10) -> DataFrame:
    """Succeeded files per upper-cased type, most first, ties by name."""
    counts = (
        succeeded(files)
        .groupBy(_type_label(F.col("file_type")).alias("file_type"))
        .agg(F.count(F.lit(1)).alias("n_files"))
        .orderBy(F.desc("n_files"), "file_type")
    )
    return counts if top is None else counts.limit(top)


def recent_projects(projects: DataFrame, n: int = 5) -> DataFrame:
    """The latest downloads; a project without a folder takes its place in the
    limit and is dropped after it."""
    latest = projects.orderBy(F.desc("download_date"), "id").limit(n)
    return latest.filter(F.col("download_project_folder") != "").select(
        "id", "download_project_folder", "download_date"
    )


def projects_per_source(projects: DataFrame, source: str = "repository_url") -> DataFrame:
    return (
        projects.groupBy(source)
        .agg(F.count(F.lit(1)).alias("n_projects"))
        .orderBy(F.desc("n_projects"), source)
    )


def run_totals(outcomes: DataFrame, project: list[str], bytes_col: str = "bytes") -> DataFrame:
    """Bytes, megabytes, projects and seconds of a run. ``outcomes`` has the bytes
    of each transfer and its ``started``/``finished`` times if they were kept."""
    moved = F.col(bytes_col) > 0
    timed = {"started", "finished"} <= set(outcomes.columns)
    # one row per project first, so that distinct projects need no second shuffle
    per_project = outcomes.groupBy(*project).agg(
        F.sum(F.when(moved, F.col(bytes_col)).otherwise(0)).alias("_bytes"),
        F.bool_or(moved).alias("_moved"),
        *([F.min("started").alias("_started"), F.max("finished").alias("_finished")] if timed else []),
    )
    total = per_project.agg(
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total_bytes"),
        F.count_if("_moved").alias("total_projects"),
        *(
            [
                F.timestamp_diff("SECOND", F.min("_started"), F.max("_finished")).alias("elapsed_seconds")
            ]
            if timed
            else []
        ),
    )
    return total.withColumn("total_mb", F.round(F.col("total_bytes") / (1024 * 1024), 2))
