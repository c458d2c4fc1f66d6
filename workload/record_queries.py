"""Accepted records and their transfers turned into table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators.filters import strict_records
from shelfmark.plans.pipeline import merge_into
from shelfmark.plans.tables import (
    arrivals,
    child_rows,
    create_tables,
    fold,
    project_id,
    read_tables,
    rejected_children,
    split_batch,
)
from shelfmark.schemas import PROJECT_ORDER, RECORD, conform
from shelfmark.session import shared_folder, stored
from shelfmark.sources.landing import entry
from workload.base import query, table

_DATE = "2024-06-01T00:00:00+00:00"


def records(spark, sf):
    """Documents as accepted records with a project file, a text and an archive."""
    docs = table(spark, sf, "documents")
    rec = F.col("doc_id").cast("string")
    en, fr, es = F.col("lang") == "en", F.col("lang") == "fr", F.col("lang") == "es"
    nameless = entry(F.lit(None).cast("string"), F.lit(""), restricted=F.lit(True))
    files = F.array(
        entry(F.when(en, "a.qdpx").otherwise("a.csv"), F.lit("https://f/a")),
        entry(F.lit(" ..b.zip"), F.lit("https://f/b")),
        entry(F.lit("c.pdf"), F.lit(""), restricted=F.lit(True), reason=F.when(fr, "Embargoed until 2030")),
    )
    rows = docs.select(
        F.when(en, F.lit("zenodo")).otherwise(F.col("source")).alias("context_repository"),
        rec.alias("recid"),
        F.concat(F.lit("p-"), rec).alias("project_identifier"),
        F.when(en, F.col("source")).alias("title"),
        F.col("text").alias("description"),
        F.when(fr, F.lit("v2")).alias("version"),
        F.when(en, F.lit("")).otherwise("mit").alias("license"),
        F.lit("cc0").alias("license_id"),
        F.array(F.concat("lang", F.lit(", "), "source"), F.col("lang")).alias("keywords"),
        F.array(F.struct(F.col("source").alias("name"), F.lit("producer").alias("role"))).alias("persons"),
        # a blank URL is none; the built one takes its place
        F.when(es, F.lit(" ")).alias("project_url"),
        # only French documents lack a project file once transferred
        F.when(fr, F.slice(files, 2, 2))
        .when(es, F.concat(files, F.array(nameless)))
        .otherwise(files).alias("files"),
    )
    return conform(rows, RECORD).withColumn("query_string", F.lit("q"))


def outcomes(spark, sf):
    """The transfer manifest: short documents failed to arrive."""
    docs = table(spark, sf, "documents")
    names = F.array(
        F.when(F.col("lang") == "en", "a.qdpx").otherwise("a.csv"), F.lit("b.zip")
    )
    return docs.select(
        F.when(F.col("lang") == "en", F.lit("zenodo")).otherwise(F.col("source")).alias("context_repository"),
        F.concat(F.lit("p-"), F.col("doc_id").cast("string")).alias("project_identifier"),
        F.when(F.col("lang") == "fr", "v2").otherwise("v1").alias("version"),
        F.explode(names).alias("file_name"),
        F.when(F.col("n_chars") > 400, F.col("n_chars")).otherwise(0).alias("bytes"),
    )


def members(spark, sf):
    """Three members per archive of the German documents; one has its dot in a folder."""
    docs = table(spark, sf, "documents").filter(F.col("lang") == "de")
    return docs.select(
        F.col("source").alias("context_repository"),
        F.concat(F.lit("p-"), F.col("doc_id").cast("string")).alias("project_identifier"),
        F.lit("v1").alias("version"),
        F.lit("b.zip").alias("archive"),
        F.explode(F.array(F.lit("in/x.nvpx"), F.lit("in/y.txt"), F.lit("data.v1/README"))).alias("member"),
        F.col("n_chars").alias("size"),
    )


@query(
    "project_rows",
    """SELECT CASE WHEN lang = 'en' THEN 1 ELSE 99 END::INT AS repository_id,
              'https://' || CASE WHEN lang = 'en' THEN 'zenodo' ELSE source END || '.org' AS repository_url,
              'https://' || CASE WHEN lang = 'en' THEN 'zenodo' ELSE source END || '.org/record/p-' || doc_id::VARCHAR AS project_url,
              CASE WHEN lang = 'fr' THEN 'v2' ELSE 'v1' END AS version,
              CASE WHEN lang = 'en' THEN source ELSE 'Unknown Title' END AS title,
              CASE WHEN lang = 'en' THEN 'cc0' ELSE 'mit' END AS license
       FROM documents""",
)
def project_rows(spark, sf):
    batch = arrivals(records(spark, sf), outcomes(spark, sf), _DATE, members(spark, sf))
    return batch.projects.select(
        "repository_id", "repository_url", "project_url", "version", "title", "license"
    )


@query(
    "project_children",
    """SELECT doc_id::VARCHAR AS recid, kind, value FROM (
           SELECT doc_id, 'failed' AS kind, 'c.pdf:pdf:' || CASE WHEN lang = 'fr' THEN 'Embargoed until 2030' ELSE 'Restricted access' END AS value FROM documents
           UNION ALL SELECT doc_id, 'failed', 'unknown::Restricted access' FROM documents WHERE lang = 'es'
           UNION ALL SELECT doc_id, 'arrived', 'a.qdpx:qdpx:' FROM documents WHERE n_chars > 400 AND lang = 'en'
           UNION ALL SELECT doc_id, 'arrived', 'a.csv:csv:' FROM documents WHERE n_chars > 400 AND lang NOT IN ('en', 'fr')
           UNION ALL SELECT doc_id, 'arrived', 'b.zip:zip:' FROM documents WHERE n_chars > 400 AND lang <> 'de'
           UNION ALL SELECT doc_id, 'arrived', unnest(['in/x.nvpx:nvpx:', 'in/y.txt:txt:', 'data.v1/README::']) FROM documents WHERE n_chars > 400 AND lang = 'de'
           UNION ALL SELECT doc_id, 'keyword', unnest([lang, source]) FROM documents
           UNION ALL SELECT doc_id, 'person', source || ':OTHER' FROM documents)""",
)
def project_children(spark, sf):
    batch = arrivals(records(spark, sf), outcomes(spark, sf), _DATE, members(spark, sf))
    recid = F.substring_index("project_url", "p-", -1).alias("recid")
    files = batch.files.select(
        recid,
        F.when(F.col("status") == "FAILED", "failed").otherwise("arrived").alias("kind"),
        F.concat_ws(":", "file_name", "file_type", "failure_reason").alias("value"),
    )
    keywords = batch.keywords.select(recid, F.lit("keyword").alias("kind"), F.col("keyword").alias("value"))
    people = batch.person_role.select(
        recid, F.lit("person").alias("kind"), F.concat_ws(":", "name", "role").alias("value")
    )
    return files.unionByName(keywords).unionByName(people)


@query(
    "quarantine_children",
    """SELECT 'keywords' AS kind, lang AS language, count(*)::BIGINT AS n FROM documents WHERE lang = 'fr' GROUP BY 2
       UNION ALL SELECT 'person_role', lang, count(*)::BIGINT FROM documents WHERE source = 'src3' GROUP BY 2""",
)
def quarantine_children(spark, sf):
    """Children without a required value go aside, their projects stay."""
    batch = arrivals(records(spark, sf), outcomes(spark, sf), _DATE, members(spark, sf))
    batch = batch._replace(
        keywords=batch.keywords.withColumn("keyword", F.when(F.col("keyword") != "fr", F.col("keyword"))),
        person_role=batch.person_role.withColumn("name", F.when(F.col("name") != "src3", F.col("name"))),
    )
    folded, _ = split_batch(batch)
    docs = table(spark, sf, "documents").select(
        F.col("lang").alias("language"),
        project_id(
            F.concat(
                F.lit("https://"), F.when(F.col("lang") == "en", "zenodo").otherwise(F.col("source")),
                F.lit(".org/record/p-"), F.col("doc_id").cast("string"),
            ),
            F.when(F.col("lang") == "fr", "v2").otherwise("v1"),
        ).alias("project_id"),
    )
    parts = [
        rows.join(docs, "project_id").groupBy(F.lit(name).alias("kind"), "language").agg(
            F.count(F.lit(1)).alias("n")
        )
        for name, rows in rejected_children(folded, batch).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "child_ids",
    """SELECT 'files' AS kind, (SELECT count(*) FROM documents WHERE n_chars > 400 AND lang IN ('en', 'es')) * 2
              + (SELECT count(*) FROM documents WHERE n_chars > 400 AND lang = 'fr')
              + (SELECT count(*) FROM documents WHERE n_chars > 400 AND lang = 'de') * 4
              + (SELECT count(*) FROM documents) * 2
              + (SELECT count(*) FROM documents WHERE lang = 'es') * 2 AS n_ids""",
)
def child_ids(spark, sf):
    """Every child row has an id of its own, equal rows too: restricted files twice."""
    batch = arrivals(records(spark, sf), outcomes(spark, sf), _DATE, members(spark, sf))
    failed = batch.files.filter("status = 'FAILED'")
    batch = batch._replace(files=batch.files.unionByName(failed))
    files = child_rows(split_batch(batch)[0], batch)["files"]
    return files.agg(F.count_distinct("id").alias("n_ids")).select(F.lit("files").alias("kind"), "n_ids")


@query(
    "created_tables",
    """SELECT t.name, t.n_columns::INT AS n_columns, 0::BIGINT AS n_rows
       FROM (VALUES ('projects', 17), ('files', 6), ('keywords', 3), ('person_role', 4)) AS t(name, n_columns)
       WHERE (SELECT count(*) FROM documents) > 0""",
)
def created_tables(spark, sf):
    """Tables are made once; a second call leaves a merged snapshot as it is."""
    folder = shared_folder(spark, "tables")
    create_tables(spark, folder)
    empty = read_tables(spark, folder)
    batch = arrivals(records(spark, sf), outcomes(spark, sf), _DATE, members(spark, sf), store=stored)
    merged = shared_folder(spark, "tables")
    merge_into(empty, batch, merged)
    create_tables(spark, merged)
    if read_tables(spark, merged).projects.isEmpty():
        raise AssertionError("a second call emptied the tables")
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            # the places of arrivals are bookkeeping, no columns of the model
            F.lit(name).alias("name"),
            F.lit(sum(c not in PROJECT_ORDER for c in df.columns)).alias("n_columns"),
            "n_rows",
        )
        for name, df in empty._asdict().items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "strict_rows",
    """SELECT 'a.qdpx' AS file_name, count(*)::BIGINT AS n FROM documents WHERE lang = 'en' AND n_chars > 400
       UNION ALL SELECT 'in/x.nvpx', count(*)::BIGINT FROM documents WHERE lang = 'de' AND n_chars > 400
       UNION ALL SELECT 'c.pdf', count(*)::BIGINT FROM documents WHERE lang IN ('en', 'de') AND n_chars > 400""",
)
def strict_rows(spark, sf):
    batch = arrivals(records(spark, sf), outcomes(spark, sf), _DATE, members(spark, sf), strict=True)
    files = child_rows(fold(batch.projects), batch)["files"]
    return files.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "strict_record_arrays",
    """SELECT doc_id::VARCHAR AS recid, 'a.qdpx' AS files FROM documents WHERE lang = 'en'""",
)
def strict_record_arrays(spark, sf):
    kept = strict_records(records(spark, sf))
    return kept.select("recid", F.array_join("files.file_key", "|").alias("files"))
