"""Joins between landed tables, dimensions and the four result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.taxonomy import REPOSITORY_IDS, UNKNOWN_REPOSITORY_ID


def repository_id(
    name: Column,
    ids: Mapping[str, int] = REPOSITORY_IDS,
    unknown: int = UNKNOWN_REPOSITORY_ID,
) -> Column:
    """Number of a repository; one test per number, no join."""
    by_id: dict[int, list[str]] = {}
    for repository, number in ids.items():
        by_id.setdefault(number, []).append(repository)
    out = F.lit(unknown)
    for number, names in by_id.items():
        out = F.when(F.lower(name).isin(names), F.lit(number)).otherwise(out)
    return out


def child_counts(
    projects: DataFrame, children: DataFrame, project_id: str = "project_id", n: str = "n"
) -> DataFrame:
    """Projects that have children, with their number.

    The children are counted per project first: that shrinks the shuffle and
    takes the skew of a project with very many children out of the join.
    """
    counts = children.groupBy(project_id).agg(F.count(F.lit(1)).alias(n))
    return projects.join(counts, projects["id"] == counts[project_id]).drop(project_id)


def orphans(
    children: DataFrame, projects: DataFrame, project_id: str = "project_id"
) -> DataFrame:
    """(project_id, n) of child rows whose project does not exist."""
    counts = children.groupBy(project_id).agg(F.count(F.lit(1)).alias("n"))
    ids = projects.select(F.col("id").alias(project_id))
    return counts.join(ids, project_id, "left_anti")


def drop_orphans(
    children: DataFrame, projects: DataFrame, project_id: str = "project_id"
) -> DataFrame:
    """Child rows with a project: the cascade of a project delete."""
    return children.join(
        projects.select(F.col("id").alias(project_id)), project_id, "left_semi"
    )


def ghost_folders(
    folders: DataFrame, projects: DataFrame, files: DataFrame
) -> DataFrame:
    """Listed folders without a succeeded file, reported and never deleted.

    ``folders`` has (repository_folder, project_folder, version_folder).
    """
    done = files.filter(F.col("status") == "SUCCEEDED").select("project_id").distinct()
    alive = projects.join(done, projects["id"] == done["project_id"], "left_semi").select(
        F.col("download_repository_folder").alias("repository_folder"),
        F.col("download_project_folder").alias("project_folder"),
        F.col("download_version_folder").alias("version_folder"),
    )
    return folders.join(
        alive, ["repository_folder", "project_folder", "version_folder"], "left_anti"
    )


def known_project_urls(projects: DataFrame) -> DataFrame:
    return projects.filter(F.col("project_url") != "").select("project_url").distinct()


def latest_by_key(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """The last landed row of every key."""
    rest = [c for c in df.columns if c not in key]
    last = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
    return last.select(*key, "_last.*").select(*df.columns)
