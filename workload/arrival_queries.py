"""Repeated arrivals merged into the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.plans import snapshots
from shelfmark.plans.tables import ARRIVAL_KEY, Arrivals, child_rows, fold, id_choice, upsert
from shelfmark.session import shared_folder
from workload.base import query, table

_SPLIT = "2024-01-16"


def arrivals(spark, sf):
    """Events as arrivals: user and type name the project, the id orders them."""
    events = table(spark, sf, "events")
    label = F.concat(F.lit("t"), F.col("event_id").cast("string"))
    return events.select(
        F.concat(F.lit("https://r/"), F.col("user_id").cast("string")).alias("project_url"),
        F.col("event_type").alias("version"),
        label.alias("title"),
        F.col("props").alias("description"),
        F.lit(None).cast("string").alias("license"),
        F.date_format("ts", "yyyy-MM-dd").alias("upload_date"),
        F.date_format("ts", "yyyy-MM-dd").alias("download_date"),
        F.lit("r").alias("download_repository_folder"),
        label.alias("download_project_folder"),
        F.col("event_type").alias("download_version_folder"),
        label.alias("query_string"),
        F.lit(1).alias("repository_id"),
        F.lit("https://r").alias("repository_url"),
        F.col("value").cast("string").alias("language"),
        F.lit("").alias("doi"),
        F.lit("SCRAPING | API").alias("download_method"),
        F.col("event_id").alias("seq"),
    )


def arrived(spark, sf):
    rows = arrivals(spark, sf)
    files = rows.select(
        *ARRIVAL_KEY,
        F.concat("title", F.lit(".qdpx")).alias("file_name"),
        F.lit("qdpx").alias("file_type"),
        F.lit("SUCCEEDED").alias("status"),
        F.lit("").alias("failure_reason"),
    )
    keywords = rows.select(*ARRIVAL_KEY, F.explode(F.array("version", "title")).alias("keyword"))
    people = rows.select(*ARRIVAL_KEY, F.col("title").alias("name"), F.lit("AUTHOR").alias("role"))
    return Arrivals(rows, files, keywords, people)


@query(
    "upsert_projects",
    """SELECT 'https://r/' || user_id::VARCHAR AS project_url, event_type AS version,
              't' || min(event_id)::VARCHAR AS query_string, 't' || max(event_id)::VARCHAR AS title,
              arg_max(props, event_id) AS description,
              strftime(arg_max(ts, event_id), '%Y-%m-%d') AS download_date
       FROM events GROUP BY user_id, event_type""",
)
def upsert_projects(spark, sf):
    rows = arrivals(spark, sf)
    # the table holds what came before the split; the batch is the rest
    early = F.col("download_date") < _SPLIT
    current = fold(rows.filter(early))
    after = upsert(current, fold(rows.filter(~early)))
    return after.select(
        "project_url", "version", "query_string", "title", "description", "download_date"
    )


@query(
    "arrival_children",
    """WITH last AS (SELECT user_id, event_type, max(event_id)::VARCHAR AS e FROM events GROUP BY 1, 2)
       SELECT 'file' AS child, 't' || e || '.qdpx' AS name FROM last
       UNION ALL SELECT 'keyword', 't' || e FROM last
       UNION ALL SELECT 'keyword', event_type FROM last
       UNION ALL SELECT 'person', 't' || e FROM last""",
)
def arrival_children(spark, sf):
    batch = arrived(spark, sf)
    children = child_rows(fold(batch.projects), batch)
    named = {
        "file": children["files"].select(F.col("file_name").alias("name")),
        "keyword": children["keywords"].select(F.col("keyword").alias("name")),
        "person": children["person_role"].select("name"),
    }
    parts = [df.select(F.lit(kind).alias("child"), "name") for kind, df in named.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _crowded(url, version, attempt):
    """Ids of ten bits at the first attempt, so most projects meet another one's."""
    choice = id_choice(url, version, attempt)
    return choice if attempt else choice.bitwiseAND(F.lit(1023))


@query(
    "ids_of_equal_hash",
    """WITH last AS (SELECT 'https://r/' || user_id::VARCHAR AS project_url, event_type AS version,
                            max(event_id)::VARCHAR AS e FROM events GROUP BY 1, 2)
       SELECT project_url, version, 't' || e || '.qdpx' AS file_name, 1::BIGINT AS n_projects FROM last""",
)
def ids_of_equal_hash(spark, sf):
    """Two merges with a hash that many projects share: every file is still that of its
    own project's last arrival, and no id stands for two projects."""
    batch = arrived(spark, sf)
    root = shared_folder(spark, "tables")
    snapshots.create(spark, root, buckets=8)
    late = F.col("seq") % 3 == 0
    for name, part in (("first", ~late), ("second", late)):
        rows = Arrivals(*[df.where(part) for df in batch])
        snapshots.merge_batch(spark, root, rows, name, _crowded)
    tables = snapshots.read(spark, root)
    ids = tables.projects.groupBy("id").agg(F.count(F.lit(1)).alias("n_projects"))
    named = tables.projects.select(F.col("id").alias("project_id"), "project_url", "version")
    return (
        tables.files.join(named, "project_id").join(ids.withColumnRenamed("id", "project_id"), "project_id")
        .select("project_url", "version", "file_name", "n_projects")
    )
