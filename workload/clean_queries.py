"""The cleaning run over tables made of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.plans.clean import best_copies, best_of_title, clean
from shelfmark.plans.tables import Tables
from shelfmark.schemas import conform
from workload.base import query, table

_MIRRORS = ["src3", "src7"]
_WORDS = {"de": ["die"], "en": ["the"]}


def tables(spark, sf):
    """A project per document. Titles are the first letters of the text, so many agree;
    some are missing. Every seventh file belongs to no project."""
    docs = table(spark, sf, "documents")
    i = F.col("doc_id")
    projects = conform(
        docs.select(
            i.alias("id"),
            F.when(i % 11 == 0, "Unknown Title").otherwise(F.concat(F.substring("text", 1, 6), F.lit(" !"))).alias("title"),
            F.when(i % 3 == 0, F.concat(F.lit("https://doi.org/10.1/"), (i % 50).cast("string"))).otherwise("").alias("doi"),
            F.col("source").alias("download_repository_folder"),
            F.when(i % 5 == 0, " ").otherwise(F.col("text")).alias("description"),
            F.when(i % 2 == 0, "").otherwise(F.col("lang")).alias("language"),
        ),
        schemas.PROJECTS,
    )
    hosted = i % 4 == 0
    files = conform(
        docs.select(
            i.alias("id"),
            F.when(i % 7 == 0, -i - 1).otherwise(i).alias("project_id"),
            F.when(i % 2 == 1, "data.v1/README").otherwise("dir/A.QDPX").alias("file_name"),
            F.lit("wrong").alias("file_type"),
            F.when(hosted, "FAILED").otherwise("SUCCEEDED").alias("status"),
            F.when(hosted, "Study hosted externally. Resource access: u").otherwise("").alias("failure_reason"),
        ),
        schemas.FILES,
    )
    keywords = conform(
        docs.select(i.alias("id"), i.alias("project_id"), F.col("lang").alias("keyword")), schemas.KEYWORDS
    )
    people = conform(
        docs.select(i.alias("id"), i.alias("project_id"), F.col("source").alias("name"), F.lit("AUTHOR").alias("role")),
        schemas.PERSON_ROLE,
    )
    return Tables(projects, files, keywords, people)


_SQL_BEST = """(
    SELECT *, row_number() OVER (PARTITION BY copy_of ORDER BY doi = '', source IN ('src3', 'src7'), doc_id) AS rn,
           count(*) OVER (PARTITION BY copy_of) AS n_versions
    FROM (SELECT *, CASE WHEN doc_id % 11 > 0 AND plain <> '' THEN 't:' || plain
                         WHEN doi <> '' THEN 'd:' || replace(doi, 'https://doi.org/', '')
                         ELSE 'i:' || doc_id::VARCHAR END AS copy_of
          FROM (SELECT *, trim(regexp_replace(lower(title), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS plain,
                       CASE WHEN doc_id % 3 = 0 THEN 'https://doi.org/10.1/' || (doc_id % 50)::VARCHAR ELSE '' END AS doi
                FROM (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'Unknown Title' ELSE substr(text, 1, 6) || ' !' END AS title
                      FROM documents))))"""


# Copies by DOI; without one by title, unless rows of that title have several DOIs.
_SQL_COPIES = """(
    SELECT *, row_number() OVER (PARTITION BY copy_of ORDER BY doi = '', source IN ('src3', 'src7'), doc_id) AS rn,
           count(*) OVER (PARTITION BY copy_of) AS n_versions
    FROM (SELECT *, CASE WHEN doi <> '' THEN 'd:' || doi
                         WHEN plain IS NULL THEN 'i:' || doc_id::VARCHAR
                         WHEN low = high THEN 'd:' || low
                         ELSE 'i:' || (min(CASE WHEN doi = '' THEN doc_id END) OVER (PARTITION BY plain))::VARCHAR END AS copy_of
          FROM (SELECT *, min(nullif(doi, '')) OVER (PARTITION BY plain) AS low,
                       max(nullif(doi, '')) OVER (PARTITION BY plain) AS high
                FROM (SELECT *, CASE WHEN doc_id % 11 > 0
                                     THEN nullif(trim(regexp_replace(lower(title), '[^\\p{L}\\p{N}]+', ' ', 'g')), '') END AS plain,
                             CASE WHEN doc_id % 3 = 0 THEN '10.1/' || (doc_id % 50)::VARCHAR ELSE '' END AS doi
                      FROM (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'Unknown Title' ELSE substr(text, 1, 6) || ' !' END AS title
                            FROM documents)))))"""


@query(
    "best_version_by_title",
    f"SELECT copy_of, doc_id AS id, n_versions::BIGINT AS n_versions FROM {_SQL_BEST} WHERE rn = 1",
)
def best_version_by_title(spark, sf):
    best = best_of_title(tables(spark, sf).projects, _MIRRORS)
    return best.withColumnRenamed("_copy_of", "copy_of")


def _linked(spark, sf):
    """Projects that share titles and addresses in chains, some with a DOI."""
    i = F.col("doc_id")
    return conform(
        table(spark, sf, "documents").select(
            i.alias("id"),
            F.substring("text", 1, 7).alias("title"),
            F.when(i % 4 != 0, F.concat(F.lit("https://r/"), F.floor(i / 3).cast("string"))).alias("project_url"),
            F.when(i % 5 == 0, F.concat(F.lit("DOI:10.1/X"), (i % 40).cast("string"))).alias("doi"),
            F.col("source").alias("download_repository_folder"),
        ),
        schemas.PROJECTS,
    )


@query(
    "best_version_graph",
    """WITH RECURSIVE recs AS (
            SELECT doc_id, source, nullif(trim(regexp_replace(lower(substr(text, 1, 7)), '[^\\p{L}\\p{N}]+', ' ', 'g')), '') AS plain,
                   CASE WHEN doc_id % 4 <> 0 THEN 'https://r/' || (doc_id // 3)::VARCHAR END AS url,
                   CASE WHEN doc_id % 5 = 0 THEN '10.1/x' || (doc_id % 40)::VARCHAR END AS doi
            FROM documents),
        open AS (SELECT * FROM recs WHERE doi IS NULL),
        edges AS (SELECT a.doc_id AS a, b.doc_id AS b FROM open a JOIN open b USING (plain)
                  UNION SELECT a.doc_id, b.doc_id FROM open a JOIN open b USING (url)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM open
                  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
        parts AS (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY a),
        claims AS (
            SELECT root, min(doi) AS low, max(doi) AS high FROM (
                SELECT p.root, r.doi FROM parts p JOIN open o USING (doc_id) JOIN recs r ON r.doi IS NOT NULL AND r.plain = o.plain
                UNION ALL
                SELECT p.root, r.doi FROM parts p JOIN open o USING (doc_id) JOIN recs r ON r.doi IS NOT NULL AND r.url = o.url)
            GROUP BY root),
        named AS (
            SELECT doc_id, source, doi, 'd:' || doi AS copy_of FROM recs WHERE doi IS NOT NULL
            UNION ALL
            SELECT o.doc_id, o.source, o.doi, CASE WHEN low = high THEN 'd:' || low ELSE 'i:' || p.root::VARCHAR END
            FROM open o JOIN parts p USING (doc_id) LEFT JOIN claims c USING (root))
        SELECT copy_of, doc_id AS id, n_versions::BIGINT AS n_versions FROM (
            SELECT *, row_number() OVER (PARTITION BY copy_of ORDER BY doi IS NULL, source IN ('src3', 'src7'), doc_id) AS rn,
                   count(*) OVER (PARTITION BY copy_of) AS n_versions FROM named)
        WHERE rn = 1""",
)
def best_version_graph(spark, sf):
    return best_copies(_linked(spark, sf), _MIRRORS)


@query(
    "clean_links",
    """SELECT doc_id AS id, 'https://s/' || doc_id::VARCHAR || '?a=1' AS link, 'url' AS file_type, lang || ', k' AS description
       FROM documents WHERE doc_id % 2 = 0 AND lang < 'k'
       UNION ALL
       SELECT doc_id, 'https://s/' || doc_id::VARCHAR || '?a=1', 'url', 'k, ' || lang
       FROM documents WHERE doc_id % 2 = 0 AND lang > 'k'""",
)
def clean_links(spark, sf):
    """Placeholders of external studies become links and keep the address; projects
    without a title and a description are described by their keywords."""
    docs = table(spark, sf, "documents").where("lang is not null")
    i = F.col("doc_id")
    projects = conform(
        docs.select(i.alias("id"), F.lit(" ").alias("title"), F.when(i % 3 == 0, "").alias("description")), schemas.PROJECTS
    )
    files = conform(
        docs.where(i % 2 == 0).select(
            i.alias("id"), i.alias("project_id"), F.lit("NOTICE.txt").alias("file_name"), F.lit("FAILED").alias("status"),
            F.concat(F.lit("Study hosted externally. Resource access: https://s/"), i.cast("string"), F.lit("?a=1")).alias("failure_reason"),
        ),
        schemas.FILES,
    )
    words = docs.select(i.alias("project_id"), F.explode(F.array("lang", F.lit("k"), "lang")).alias("keyword"))
    none = conform(docs.limit(0), schemas.PERSON_ROLE)
    done = clean(Tables(projects, files, conform(words, schemas.KEYWORDS), none)).tables
    linked = done.files.where("status = 'SUCCEEDED' and file_name = 'external_study.url'")
    return done.projects.select("id", "description").join(
        linked.select(F.col("project_id").alias("id"), F.col("failure_reason").alias("link"), "file_type"), "id"
    )


@query(
    "clean_tables",
    f"""WITH best AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN title ELSE text END AS description FROM {_SQL_COPIES} WHERE rn = 1),
        votes AS (SELECT *, len(list_filter(regexp_split_to_array(lower(description), '[^\\p{{L}}]+'), lambda w: w = 'die')) AS de,
                         len(list_filter(regexp_split_to_array(lower(description), '[^\\p{{L}}]+'), lambda w: w = 'the')) AS en
                  FROM best)
        SELECT doc_id AS id, md5(description) AS description,
               CASE WHEN doc_id % 2 = 1 THEN lang WHEN greatest(de, en) = 0 THEN NULL
                    WHEN de >= en THEN 'de' ELSE 'en' END AS language,
               CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN 'external_study.url:url:SUCCEEDED'
                    WHEN doc_id % 2 = 1 THEN 'data.v1/README::SUCCEEDED' ELSE 'dir/A.QDPX:qdpx:SUCCEEDED' END AS file,
               lang AS keyword, source AS person
        FROM votes""",
)
def clean_tables(spark, sf):
    done = clean(tables(spark, sf), aggregators=_MIRRORS, stop_words=_WORDS).tables
    file = F.concat_ws(":", "file_name", "file_type", "status").alias("file")
    projects = done.projects.select("id", F.md5("description").alias("description"), "language")
    return (
        projects.join(done.files.select(F.col("project_id").alias("id"), file), "id", "left")
        .join(done.keywords.select(F.col("project_id").alias("id"), "keyword"), "id")
        .join(done.person_role.select(F.col("project_id").alias("id"), F.col("name").alias("person")), "id")
    )


@query(
    "clean_reports",
    f"""SELECT 'orphans' AS report, count(*)::BIGINT AS n FROM documents WHERE doc_id % 7 = 0
        UNION ALL SELECT 'copies', sum(n_versions)::BIGINT FROM {_SQL_COPIES} WHERE rn = 1 AND n_versions > 1""",
)
def clean_reports(spark, sf):
    done = clean(tables(spark, sf), aggregators=_MIRRORS, stop_words=_WORDS)
    lost = done.orphans.agg(F.sum("n").alias("n")).select(F.lit("orphans").alias("report"), "n")
    copies = done.duplicates.filter("n_versions > 1").agg(F.sum("n_versions").alias("n"))
    return lost.unionByName(copies.select(F.lit("copies").alias("report"), "n"))
