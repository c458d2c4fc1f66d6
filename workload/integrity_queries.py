"""Keys between the tables: orphans, cascades, ghost folders, best versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import dedupe, joins
from shelfmark.plans.tables import quarantine, replace_children
from workload.base import SQL_FILES, SQL_PROJECTS, files_table, projects_table, query, table


def _alive(spark, sf):
    return projects_table(spark, sf).filter(F.col("status") != "P")


@query(
    "orphans",
    f"""SELECT project_id, count(*)::BIGINT AS n FROM {SQL_FILES}
        WHERE project_id NOT IN (SELECT id FROM {SQL_PROJECTS} WHERE status <> 'P') GROUP BY 1""",
)
def orphans(spark, sf):
    return joins.orphans(files_table(spark, sf), _alive(spark, sf))


@query(
    "cascade_delete",
    f"""SELECT status, count(*)::BIGINT AS n_files, sum(bytes)::BIGINT AS bytes FROM {SQL_FILES}
        WHERE project_id IN (SELECT id FROM {SQL_PROJECTS} WHERE status <> 'P') GROUP BY 1""",
)
def cascade_delete(spark, sf):
    kept = joins.drop_orphans(files_table(spark, sf), _alive(spark, sf))
    return kept.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes")
    )


@query(
    "child_replace",
    f"""SELECT file_type, count(*)::BIGINT AS n_files FROM (
            SELECT file_type FROM {SQL_FILES}
            WHERE project_id NOT IN (SELECT id FROM {SQL_PROJECTS} WHERE status = 'O')
            UNION ALL
            SELECT 'new' FROM {SQL_PROJECTS} WHERE status = 'O') GROUP BY 1""",
)
def child_replace(spark, sf):
    touched = projects_table(spark, sf).filter(F.col("status") == "O").select(
        F.col("id").alias("project_id")
    )
    current = files_table(spark, sf).select("project_id", "file_type")
    fresh = touched.withColumn("file_type", F.lit("new"))
    after = replace_children(current, touched, fresh)
    return after.groupBy("file_type").agg(F.count(F.lit(1)).alias("n_files"))


@query(
    "required_columns",
    """SELECT 'bad' AS part, count(*)::BIGINT AS n FROM conversations WHERE role = 'system'
       UNION ALL SELECT 'good', count(*)::BIGINT FROM conversations WHERE role <> 'system'""",
)
def required_columns(spark, sf):
    people = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("project_id"),
        F.col("text").alias("name"),
        F.nullif("role", F.lit("system")).alias("role"),
    )
    good, bad = quarantine(people, "person_role")
    parts = good.withColumn("part", F.lit("good")).unionByName(bad.withColumn("part", F.lit("bad")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ghost_folders",
    f"""SELECT 'p-' || id::VARCHAR AS project_folder FROM {SQL_PROJECTS} WHERE status <> 'P'
        AND id NOT IN (SELECT project_id FROM {SQL_FILES} WHERE status = 'SUCCEEDED')""",
)
def ghost_folders(spark, sf):
    projects = _alive(spark, sf).select(
        "id",
        F.col("repository_url").alias("download_repository_folder"),
        "download_project_folder",
        F.lit("v1").alias("download_version_folder"),
    )
    listing = projects.select(
        F.col("download_repository_folder").alias("repository_folder"),
        F.col("download_project_folder").alias("project_folder"),
        F.col("download_version_folder").alias("version_folder"),
    )
    ghosts = joins.ghost_folders(listing, projects, files_table(spark, sf))
    return ghosts.select("project_folder")


@query(
    "best_version",
    """WITH ranked AS (
           SELECT d.doc_id, d.text, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END AS no_doi,
                  CASE WHEN d.source IN ('src3', 'src7') THEN 1 ELSE 0 END AS mirrored
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
       SELECT arg_min(doc_id, no_doi * 1000000000000000 + mirrored * 100000000000000 + doc_id)::BIGINT AS doc_id,
              count(*)::BIGINT AS n_versions
       FROM ranked GROUP BY text""",
)
def best_version(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("content"))
    labels = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("has_doi"))
    known = docs.join(labels, "doc_id", "left")
    prefer = [
        ("_doi", F.when(F.col("has_doi"), 0).otherwise(1)),
        ("_direct", F.col("source").isin("src3", "src7").cast("int")),
    ]
    return dedupe.best_versions(known, ["content"], "doc_id", prefer).drop("content")
