"""File names, types and telemetry over projects and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import (
    file_ext,
    file_tier,
    is_project_file,
    is_required_file,
    safe_filename,
    software_name,
)
from shelfmark.operators import filters
from shelfmark.operators.joins import repository_id
from shelfmark.operators.quality import repair_file_types
from shelfmark.plans import telemetry
from shelfmark.taxonomy import FILE_TYPES, REPOSITORY_IDS
from workload.base import SQL_FILES, SQL_PROJECTS, files_table, projects_table, query, table


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


SQL_TIER = f"""CASE WHEN ext IN {_in(FILE_TYPES.project)} THEN 1
    WHEN ext IN {_in([*FILE_TYPES.text, *FILE_TYPES.archive])} THEN 2
    WHEN ext IN {_in(FILE_TYPES.media)} THEN 3 ELSE 0 END"""

SQL_SOFTWARE = "CASE " + " ".join(
    f"WHEN ext IN {_in(exts)} THEN '{name}'" for name, exts in FILE_TYPES.software.items()
) + " END"


@query(
    "file_classes",
    f"""SELECT ext, ({SQL_TIER})::INT AS tier, ext IN {_in(FILE_TYPES.project)} AS is_qda,
               ext IN {_in(FILE_TYPES.required)} AS is_required_qda, count(*)::BIGINT AS n_files
        FROM {SQL_FILES} GROUP BY ALL""",
)
def file_classes(spark, sf):
    files = files_table(spark, sf).select(file_ext(F.col("file_name")).alias("ext"))
    ext = F.col("ext")
    # classes depend on the extension alone: count first, classify the few left
    counts = files.groupBy("ext").agg(F.count(F.lit(1)).alias("n_files"))
    return counts.select(
        "ext",
        file_tier(ext).alias("tier"),
        is_project_file(ext).alias("is_qda"),
        is_required_file(ext).alias("is_required_qda"),
        "n_files",
    )


@query(
    "software_counts",
    f"""SELECT {SQL_SOFTWARE} AS software, count(*)::BIGINT AS n_files, sum(bytes)::BIGINT AS bytes
        FROM {SQL_FILES} WHERE {SQL_SOFTWARE} IS NOT NULL GROUP BY 1""",
)
def software_counts(spark, sf):
    per_ext = files_table(spark, sf).groupBy(file_ext(F.col("file_name")).alias("ext")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes")
    )
    named = per_ext.withColumn("software", software_name(F.col("ext")))
    return (
        named.filter(F.col("software").isNotNull())
        .groupBy("software")
        .agg(F.sum("n_files").alias("n_files"), F.sum("bytes").alias("bytes"))
    )


@query(
    "safe_filenames",
    """SELECT url, CASE WHEN n = '' THEN 'unnamed_file' ELSE n END AS name
       FROM (SELECT url, trim(replace(replace(url, 'e', '.'), '..', '')) AS n FROM pages)""",
)
def safe_filenames(spark, sf):
    pages = table(spark, sf, "pages")
    dotted = F.replace("url", F.lit("e"), F.lit("."))
    return pages.select("url", safe_filename(dotted).alias("name"))


@query(
    "telemetry_totals",
    f"""SELECT (SELECT count(*) FROM {SQL_FILES} WHERE status = 'SUCCEEDED')::BIGINT AS total_files,
               (SELECT count(DISTINCT id) FROM {SQL_PROJECTS})::BIGINT AS total_projects""",
)
def telemetry_totals(spark, sf):
    return telemetry.totals(projects_table(spark, sf), files_table(spark, sf))


@query(
    "files_per_repository",
    f"""SELECT p.repository_url, count(*)::BIGINT AS n_files
        FROM {SQL_PROJECTS} p LEFT JOIN {SQL_FILES} f ON p.id = f.project_id
        WHERE f.status = 'SUCCEEDED' GROUP BY 1""",
)
def files_per_repository(spark, sf):
    return telemetry.files_per_repository(projects_table(spark, sf), files_table(spark, sf))


@query(
    "files_by_type_top10",
    f"""SELECT CASE WHEN file_type = '' THEN 'UNKNOWN' ELSE upper(file_type) END AS file_type,
               count(*)::BIGINT AS n_files
        FROM {SQL_FILES} WHERE status = 'SUCCEEDED' GROUP BY 1
        ORDER BY n_files DESC, file_type LIMIT 10""",
)
def files_by_type(spark, sf):
    return telemetry.files_by_type(files_table(spark, sf))


@query(
    "recent_projects",
    f"""SELECT id, download_project_folder, download_date
        FROM (SELECT * FROM {SQL_PROJECTS} ORDER BY download_date DESC, id LIMIT 5)
        WHERE download_project_folder <> ''""",
)
def recent_projects(spark, sf):
    return telemetry.recent_projects(projects_table(spark, sf))


@query(
    "projects_per_source",
    f"SELECT repository_url, count(*)::BIGINT AS n_projects FROM {SQL_PROJECTS} GROUP BY 1",
)
def projects_per_source(spark, sf):
    return telemetry.projects_per_source(projects_table(spark, sf))


@query(
    "run_totals",
    f"""SELECT sum(bytes)::BIGINT AS total_bytes, count(DISTINCT project_id)::BIGINT AS total_projects,
               date_diff('second', min(finished), max(finished))::BIGINT AS elapsed_seconds,
               round(sum(bytes) / (1024 * 1024), 2)::DOUBLE AS total_mb
        FROM {SQL_FILES}""",
)
def run_totals(spark, sf):
    outcomes = files_table(spark, sf).withColumn("started", F.col("finished"))
    return telemetry.run_totals(outcomes, ["project_id"])


@query(
    "strict_projects",
    f"""SELECT project_id, count(*)::BIGINT AS n_project_files
        FROM {SQL_FILES} WHERE ext IN {_in(FILE_TYPES.project)} GROUP BY 1""",
)
def strict_projects(spark, sf):
    kept = filters.project_files_only(files_table(spark, sf))
    return kept.groupBy("project_id").agg(F.count(F.lit(1)).alias("n_project_files"))


@query(
    "restricted_split",
    f"""SELECT 'accessible' AS part, status, count(*)::BIGINT AS n_files FROM {SQL_FILES} WHERE NOT restricted GROUP BY 1, 2
        UNION ALL
        SELECT 'restricted', status, count(*)::BIGINT FROM {SQL_FILES} WHERE restricted GROUP BY 1, 2""",
)
def restricted_split(spark, sf):
    accessible, restricted = filters.split_restricted(files_table(spark, sf))
    parts = accessible.withColumn("part", F.lit("accessible")).unionByName(
        restricted.withColumn("part", F.lit("restricted"))
    )
    return parts.groupBy("part", "status").agg(F.count(F.lit(1)).alias("n_files"))


@query(
    "kept_records",
    f"""SELECT id, repository_url FROM {SQL_PROJECTS} p
        WHERE EXISTS (SELECT 1 FROM {SQL_FILES} f WHERE f.project_id = p.id
                      AND (f.restricted OR f.status = 'SUCCEEDED'))""",
)
def kept_records(spark, sf):
    shown = files_table(spark, sf).filter(F.col("restricted") | (F.col("status") == "SUCCEEDED"))
    ids = shown.select(F.col("project_id").alias("id")).distinct()
    projects = projects_table(spark, sf).select("id", "repository_url")
    return projects.join(ids, "id", "left_semi")


@query(
    "outcome_rows",
    f"""SELECT CASE WHEN restricted OR bytes <= 20000 THEN 'FAILED' ELSE 'SUCCEEDED' END AS outcome,
               CASE WHEN restricted THEN 'Restricted access' ELSE '' END AS failure_reason,
               count(*)::BIGINT AS n_files
        FROM {SQL_FILES} GROUP BY 1, 2""",
)
def outcome_rows(spark, sf):
    from shelfmark.functions import failure_reason

    files = files_table(spark, sf)
    failed = F.col("restricted") | (F.col("bytes") <= 20000)
    reason = F.when(F.col("restricted"), failure_reason(F.lit(""))).otherwise("")
    return files.groupBy(
        F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("outcome"),
        reason.alias("failure_reason"),
    ).agg(F.count(F.lit(1)).alias("n_files"))


@query(
    "administrative_files",
    """SELECT url, lower(f) IN ('article.html', 'abstract', 'summary.pdf') OR contains(lower(f), 'index.html') AS administrative,
              contains(lower(f), 'easy-migration.zip') OR contains(lower(f), 'manifest') AS migration
       FROM (SELECT url, replace(replace(split_part(url, '/', -1), '?page=2&ref=x', 'Index.html'), '#top', 'manifest') AS f FROM pages)""",
)
def administrative_files(spark, sf):
    name = F.substring_index("url", "/", -1)
    name = F.replace(name, F.lit("?page=2&ref=x"), F.lit("Index.html"))
    name = F.replace(name, F.lit("#top"), F.lit("manifest"))
    pages = table(spark, sf, "pages").select("url", name.alias("f"))
    return pages.select(
        "url",
        filters.is_administrative(F.col("f")).alias("administrative"),
        filters.is_administrative(F.col("f"), [], filters.MIGRATION_FILE_PARTS).alias("migration"),
    )


_IDS = "CASE " + " ".join(
    f"WHEN lower(name) = '{name}' THEN {number}" for name, number in REPOSITORY_IDS.items()
) + " ELSE 99 END"


@query(
    "repository_ids",
    f"""SELECT name, ({_IDS})::INT AS repository_id, n_orders FROM (
            SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Zenodo' WHEN '2-HIGH' THEN 'dans_life'
                        WHEN '3-MEDIUM' THEN 'icpsr' WHEN '5-LOW' THEN 'murray' ELSE o_orderpriority END AS name,
                   count(*)::BIGINT AS n_orders FROM orders GROUP BY 1)""",
)
def repository_ids(spark, sf):
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority == "1-URGENT", "Zenodo")
        .when(priority == "2-HIGH", "dans_life")
        .when(priority == "3-MEDIUM", "icpsr")
        .when(priority == "5-LOW", "murray")
        .otherwise(priority)
    )
    counts = table(spark, sf, "orders").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.select("name", repository_id(F.col("name")).alias("repository_id"), "n_orders")


@query(
    "file_type_repair",
    f"""SELECT file_type, count(*)::BIGINT AS n_files FROM {SQL_FILES} GROUP BY 1""",
)
def file_type_repair(spark, sf):
    broken = files_table(spark, sf).withColumn("file_type", F.upper("file_type"))
    fixed = repair_file_types(broken)
    return fixed.groupBy("file_type").agg(F.count(F.lit(1)).alias("n_files"))
