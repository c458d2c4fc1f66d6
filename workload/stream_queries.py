"""The same answers from a stream that reads all there is and stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.plans import snapshots
from shelfmark.plans.tables import arrivals, empty_tables, no_rows
from shelfmark.schemas import RECORD, conform
from shelfmark.session import shared_folder, stored
from shelfmark.sources.landing import entry
from shelfmark.streaming import (
    drain,
    first_in_log,
    latest_telemetry,
    live_counts,
    merge_log,
    read_stream,
    seen_rows,
    telemetry_query,
    update_seen,
)
from workload.base import query, table


OUTCOMES = "context_repository string, project_identifier string, version string, file_name string, bytes bigint"


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_stream(spark, sf, schema, glob="events.parquet")


def _landed(spark, sf, twice=False):
    """The events as a stream over several files, the latest days first, so most rows
    arrive after far later ones; one file per trigger."""
    events = table(spark, sf, "events")
    folder = shared_folder(spark, "landed")
    week = F.pmod(F.weekofyear("ts"), F.lit(3))
    for part in (2, 1, 0):
        events.filter(week == part).write.mode("append").parquet(folder)
        if twice:
            events.filter(week == part).write.mode("append").parquet(folder)
    return read_stream(spark, folder, events.schema, files_per_trigger=1)


@query(
    "stream_dedupe",
    """SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT event_id)::BIGINT AS n_ids
       FROM events GROUP BY 1""",
)
def stream_dedupe(spark, sf):
    """Every event arrives twice, out of order; none is lost and none is counted again."""
    log = drain(_landed(spark, sf, twice=True), "dedupe")
    kept = first_in_log(log, ["event_id"], ["ts"])
    return kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids")
    )


# What the first arrival of a project gave for good and the last one gave anew.
_SQL_UPSERT = """WITH ranked AS (
            SELECT *, 'https://zenodo.org/record/user-' || user_id::VARCHAR AS url,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z
            FROM events)
        SELECT f.url AS project_url, l.event_id::VARCHAR AS title, f.event_type AS language,
               CASE WHEN l.event_type = 'click' THEN 'file.csv' ELSE 'file.qdpx' END AS files,
               l.event_type AS keywords
        FROM ranked f JOIN ranked l USING (user_id) WHERE f.a = 1 AND l.z = 1"""


def _found(log):
    """Events as records, with their moment; two of one moment follow each other by id.
    Kept, as the merges read them many times."""
    name = F.when(F.col("event_type") == "click", "file.csv").otherwise("file.qdpx")
    moment = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("#"),
        F.lpad(F.col("event_id").cast("string"), 12, "0"),
    )
    rows = conform(
        log.select(
            F.lit("zenodo").alias("context_repository"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("project_identifier"),
            F.col("event_id").cast("string").alias("title"),
            F.col("event_type").alias("language"),
            moment.alias("description"),
            F.array("event_type").alias("keywords"),
            F.array(entry(name, F.lit(""), restricted=F.lit(True))).alias("files"),
        ),
        RECORD,
    ).withColumn("query_string", F.lit(""))
    return stored(rows, "log")


def _arrivals(spark, found):
    none = no_rows(spark, OUTCOMES)
    return arrivals(found, none, F.col("description"), store=stored)


def _with_children(tables):
    children = tables.files.groupBy("project_id").agg(
        F.array_join(F.array_sort(F.collect_list("file_name")), "|").alias("files")
    ).join(
        tables.keywords.groupBy("project_id").agg(
            F.array_join(F.array_sort(F.collect_list("keyword")), "|").alias("keywords")
        ),
        "project_id",
    )
    return tables.projects.join(children, F.col("id") == F.col("project_id")).select(
        "project_url", "title", "language", "files", "keywords"
    )


@query("stream_upsert", _SQL_UPSERT)
def stream_upsert(spark, sf):
    """Many arrivals of a project in one log, out of order: the table holds what the
    first gave for good and the last gave anew, and the children of the last alone.
    The merge runs twice, which changes nothing."""
    log = first_in_log(drain(_landed(spark, sf), "upsert"), ["event_id"], ["ts"])
    batch = _arrivals(spark, _found(log))
    once = merge_log(empty_tables(spark), batch)
    return _with_children(merge_log(once, batch, since="1970-01-01"))


@query("stream_upsert_late", _SQL_UPSERT)
def stream_upsert_late(spark, sf):
    """The same in two merges into tables in buckets, the later half of all events first:
    what it gave is still there after the older half, which only adds what it knew
    before. The first batch is offered again and not merged again."""
    log = first_in_log(drain(_landed(spark, sf), "late"), ["event_id"], ["ts"])
    found = _found(log)
    # the moment is text that sorts like time
    late = F.col("description") >= "2024-01-16"
    later, older = (_arrivals(spark, found.where(half)) for half in (late, ~late))
    root = shared_folder(spark, "tables")
    snapshots.create(spark, root, buckets=8)
    for name, batch in (("later", later), ("older", older), ("later", later)):
        snapshots.merge_batch(spark, root, batch, name)
    return _with_children(snapshots.read(spark, root))


@query(
    "stream_seen",
    """SELECT user_id, event_id, event_type, value FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
       WHERE rn = 1""",
)
def stream_seen(spark, sf):
    """The first event of every user as the state of a stream. Most events land late; the
    second run takes in what has landed since the first one only."""
    events = table(spark, sf, "events")
    landing, state = shared_folder(spark, "landed"), shared_folder(spark, "seen")
    week = F.pmod(F.weekofyear("ts"), F.lit(3))
    for parts in ((2,), (1, 0)):
        for part in parts:
            events.filter(week == part).write.mode("append").parquet(landing)
        stream = read_stream(spark, landing, events.schema, files_per_trigger=1)
        update_seen(stream, ["user_id"], ["ts", "event_id"], state).awaitTermination()
    first = seen_rows(spark, events.schema, ["user_id"], state)
    return first.select("user_id", "event_id", "event_type", "value")


@query(
    "stream_telemetry",
    """SELECT event_type, count(*)::BIGINT AS n, sum((props::JSON->>'$.k')::BIGINT)::BIGINT AS total
       FROM events GROUP BY 1""",
)
def stream_telemetry(spark, sf):
    events = _events(spark, sf).withColumn("k", F.from_json("props", "struct<k bigint>")["k"])
    folder = shared_folder(spark, "telemetry")
    running = telemetry_query(
        live_counts(events, ["event_type"], "k"), f"{folder}/counts", f"{folder}/progress", once=True
    )
    running.awaitTermination()
    return latest_telemetry(spark, f"{folder}/counts")
