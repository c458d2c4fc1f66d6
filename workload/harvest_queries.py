"""Readers and acceptance, on responses that Spark builds from ``documents``.

A document plays a repository record: it is listed under every search term its
text holds, fifty records a page, and its detail responses carry its fields in
the shape of the source.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from shelfmark.operators.phrases import term_hits
from shelfmark.plans.acquire import Search, accept, accepted_per_source, policy_for, searched
from shelfmark.plans.pipeline import stored
from shelfmark.schemas import LANDING, conform
from shelfmark.sources import READERS, archive_members
from shelfmark.sources.oai import read_oai
from shelfmark.sources.zenodo import recent_open
from workload.base import STRICT, TERMS, WEIGHTS, query, sql_score, sql_terms, table

PAGE = 50


def _docs(spark, sf):
    return table(spark, sf, "documents").withColumn("rec", F.col("doc_id").cast("string"))


def _listed(docs, item, opening, closing):
    """Search responses: the items of a page joined into the body of the source.
    A page lists at most ``PAGE`` records, so that is what is collected."""
    hits = term_hits(docs.withColumn("item", item), "text", TERMS, ["doc_id", "item"])
    at = F.struct("doc_id", "item")
    pages = hits.groupBy(
        "term", "term_rank", F.floor(F.col("doc_id") / PAGE).cast("int").alias("page")
    ).agg(F.array_sort(F.collect_list(at)).alias("items"))
    body = F.concat(F.lit(opening), F.array_join("items.item", ","), F.lit(closing))
    return conform(pages.select(F.lit("search").alias("kind"), "term", "term_rank", "page", body.alias("body")), LANDING)


def _answers(docs, kind, key, body):
    return conform(
        docs.select(F.lit(kind).alias("kind"), key.alias("key"), F.col("doc_id").alias("seq"), body.alias("body")),
        LANDING,
    )


def _json(**fields):
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _accepted(landing, source, user_query=False):
    harvest = READERS[source](landing, source)
    return accept(
        harvest, policy_for(source, user_query), None, WEIGHTS, strict_terms=STRICT,
        store=stored,
    )


def _names(files="files"):
    return F.array_join(F.col(f"{files}.file_key"), "|")


_HITS = f"""(SELECT d.doc_id, d.doc_id::VARCHAR AS recid, d.text, d.lang, d.source, d.n_chars, t.term_rank, t.term,
                    t.is_strict, {sql_score('lower(d.text)')} AS score
             FROM documents d JOIN {sql_terms()} ON contains(lower(d.text), lower(t.term)))"""


def _sql_first(accept_sql: str, retry: bool) -> str:
    """Accepted records with the term that brought them."""
    first = f"""SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY term_rank) AS rn FROM {_HITS}
                {f'WHERE {accept_sql}' if retry else ''}"""
    return f"(SELECT * FROM ({first}) WHERE rn = 1 AND ({accept_sql}))"


# --- Zenodo -------------------------------------------------------------------


def zenodo_landing(spark, sf):
    docs = _docs(spark, sf)
    search = _listed(docs, _json(id=F.col("doc_id")), '{"hits":{"hits":[', "]}}")
    project = F.when(F.col("lang") == "en", F.lit(".qdpx")).otherwise(F.lit(".csv"))
    first = _json(key=F.concat(F.lit("f"), "rec", project), links=F.struct(F.concat(F.lit("https://z/"), "rec").alias("self")))
    page = _json(filename=F.lit("Article.HTML"), href=F.lit("https://z/a"))
    last = _json(filename=F.lit("notes.txt"), href=F.concat(F.lit("https://z/n/"), "rec"))
    listing = F.concat(F.lit("["), first, F.lit(","), page, F.lit(","), last, F.lit("]"))
    files = (
        F.when(F.col("lang") == "en", listing)
        .when(F.col("lang") == "fr", F.concat(F.lit('{"enabled":true,"entries":'), listing, F.lit("}")))
        .otherwise(F.concat(F.lit('{"x":'), first, F.lit(',"y":'), page, F.lit(',"z":'), last, F.lit("}")))
    )
    license = F.when(F.col("lang") == "en", '{"id":"cc-by"}').when(F.col("lang") == "fr", '"cc0"').otherwise("null")
    text = _json(t=F.col("text"))
    body = F.concat(
        F.lit('{"id":'), "rec", F.lit(',"metadata":{"description":'),
        F.expr("substring(%s, 6, length(%s) - 6)" % ("_t", "_t")),
        F.lit(',"title":"'), "source", F.lit('","license":'), license,
        F.lit(',"creators":[{"name":"'), "source", F.lit('"},{"person_or_org":{"name":"'), "lang",
        F.lit('"}},{"name":""}],"access_right":"'),
        F.when(F.col("doc_id") % 3 == 0, "restricted").otherwise("open"),
        F.lit('"},"created":"2024-0'), (F.col("doc_id") % 3 + 4).cast("string"),
        F.lit('-20T10:00:00+00:00","files":'), files, F.lit("}"),
    )
    detail = _answers(docs.withColumn("_t", text), "detail", F.col("rec"), body)
    return search.unionByName(detail)


@query(
    "read_zenodo",
    f"""SELECT recid, source || '-' || recid AS project_identifier,
               CASE lang WHEN 'en' THEN 'cc-by' WHEN 'fr' THEN 'cc0' END AS license,
               'f' || recid || CASE lang WHEN 'en' THEN '.qdpx' ELSE '.csv' END || '|notes.txt' AS files,
               CASE lang WHEN 'en' THEN '1,2' ELSE '2,2' END AS tiers,
               source || '|' || lang AS creators, term AS query_string
        FROM {_sql_first('score >= 10', True)}""",
)
def read_zenodo(spark, sf):
    kept = _accepted(zenodo_landing(spark, sf), "zenodo")
    return kept.select(
        "recid", "project_identifier", "license",
        _names().alias("files"),
        F.array_join(F.col("files.tier").cast("array<string>"), ",").alias("tiers"),
        F.array_join("creators.name", "|").alias("creators"),
        "query_string",
    )


@query(
    "read_zenodo_recent",
    f"""SELECT recid, term AS query_string FROM {_sql_first('score >= 10', True)} WHERE doc_id % 3 = 1""",
)
def read_zenodo_recent(spark, sf):
    """Open records of the last thirty days only: created in May, read in June."""
    harvest = recent_open(READERS["zenodo"](zenodo_landing(spark, sf), "zenodo"), "2024-06-01")
    kept = accept(harvest, policy_for("zenodo"), None, WEIGHTS, strict_terms=STRICT, store=stored)
    return kept.select("recid", "query_string")


@query(
    "searched_zenodo",
    f"""SELECT recid, min_by(term, term_rank) AS query_string
        FROM {_HITS} WHERE score >= 10 AND doc_id % 3 = 1 AND term = 'MIT License' GROUP BY recid""",
)
def searched_zenodo(spark, sf):
    """What a run of one day asks for: this source takes longer phrases only, here the
    user's, and open records of the last days."""
    harvest = READERS["zenodo"](zenodo_landing(spark, sf), "zenodo")
    search = Search(query='"MIT License" OR no such term', run_date="2024-06-01")
    kept = accept(
        searched(harvest, "zenodo", search), policy_for("zenodo"), None, WEIGHTS, strict_terms=STRICT, store=stored
    )
    return kept.select("recid", "query_string")


# --- Dryad --------------------------------------------------------------------


def dryad_landing(spark, sf):
    docs = _docs(spark, sf)
    doi = F.concat(F.lit("doi:10.5/"), "rec")
    version = F.concat(F.lit("/api/v/"), "rec")
    links = lambda name, href: F.struct(F.struct(href.alias("href")).alias(name))
    item = _json(
        identifier=doi, title=F.col("source"), abstract=F.col("text"), _links=links("stash:version", version)
    )
    search = _listed(docs, item, '{"_embedded":{"stash:datasets":[', "]}}")
    author = F.struct(F.lit("Ada").alias("firstName"), F.concat(F.col("lang"), F.lit(" ")).alias("lastName"))
    versions = _answers(
        docs,
        "version",
        F.concat(F.lit("https://datadryad.org"), version),
        _json(
            title=F.concat(F.col("source"), F.lit(" data")),
            license=F.when(F.col("lang") == "en", "https://x/licenses/CC-BY/4.0/").when(F.col("lang") == "de", "custom"),
            authors=F.array(author),
            # a version without files ends the chain
            _links=F.when(F.col("lang") != "es", links("stash:files", F.concat(F.lit("https://datadryad.org/api/f/"), "rec"))),
        ),
    )
    entry = lambda path, href: F.struct(path.alias("path"), links("stash:download", href).alias("_links"))
    files = _answers(
        docs,
        "files",
        F.concat(F.lit("https://datadryad.org/api/f/"), "rec"),
        _json(
            _embedded=F.struct(
                F.array(
                    entry(F.concat(F.lit("dir/a"), "rec", F.lit(".QDC")), F.concat(F.lit("/dl/"), "rec")),
                    entry(F.lit("b.csv"), F.lit("/dl/b")),
                    entry(F.lit("c.pdf"), F.lit("http://other/c")),
                    entry(F.lit("d.pdf"), F.lit(None).cast("string")),
                ).alias("stash:files")
            )
        ),
    )
    return search.unionByName(versions).unionByName(files)


@query(
    "read_dryad",
    f"""SELECT 'doi:10.5/' || recid AS recid, source || '-data-10.5-' || recid AS project_identifier,
               CASE lang WHEN 'en' THEN 'cc-by' WHEN 'de' THEN 'custom' ELSE 'cc0' END AS license_id,
               lang || ', Ada' AS creators_text, 'a' || recid || '.QDC|c.pdf' AS files,
               'https://datadryad.org/dl/' || recid || '|http://other/c' AS urls, term AS query_string
        FROM {_sql_first('score >= 10', True)} WHERE lang <> 'es'""",
)
def read_dryad(spark, sf):
    kept = _accepted(dryad_landing(spark, sf), "dryad")
    return kept.select(
        "recid", "project_identifier", "license_id", "creators_text",
        _names().alias("files"), F.array_join("files.file_url", "|").alias("urls"), "query_string",
    )


# --- Dataverse ----------------------------------------------------------------


def dataverse_landing(spark, sf):
    docs = _docs(spark, sf)
    gid = F.concat(F.lit("doi:10.7/"), "rec")
    author = F.when(F.col("lang") == "en", F.concat(F.lit('{"name":"'), "source", F.lit('"}'))).otherwise('"plain"')
    text = _json(t=F.col("text"))
    described = F.expr("substring(_t, 6, length(_t) - 6)")
    item = F.concat(
        F.lit('{"global_id":"'), gid, F.lit('","name":"'), "source", F.lit('","description":'),
        F.when(F.col("lang") == "en", F.concat(F.lit("["), described, F.lit(',"more"]'))).otherwise(described),
        F.lit(',"authors":['), author, F.lit("]}"),
    )
    search = _listed(docs.withColumn("_t", text), item, '{"data":{"items":[', "]}}")

    def listed(name, restricted, embargo=F.lit(None).cast("string")):
        return F.struct(
            restricted.alias("restricted"),
            embargo.alias("embargoDate"),
            F.struct(F.col("doc_id").alias("id"), name.alias("filename")).alias("dataFile"),
        )

    files = F.array(
        listed(F.lit("a.qdpx"), F.col("lang") == "en", F.when(F.col("n_chars") > 500, F.lit("2030-01-01"))),
        listed(F.lit("b.csv"), F.lit(False)),
        listed(F.lit("MANIFEST.txt"), F.lit(False)),
    )
    detail = _answers(
        docs, "detail", gid, _json(data=F.struct(F.struct(files.alias("files")).alias("latestVersion")))
    )
    return search.unionByName(detail)


@query(
    "read_dataverse",
    f"""SELECT doi, project_identifier, creators, description, files, tiers, urls, reasons, query_string FROM (
            SELECT 'doi:10.7/' || recid AS doi, source || '-doi-10.7-' || recid AS project_identifier,
                   CASE WHEN lang = 'en' THEN source ELSE '' END AS creators,
                   CASE WHEN lang = 'en' THEN text || ' more' ELSE text END AS description,
                   'a.qdpx|b.csv' AS files, '1|2' AS tiers,
                   CASE WHEN lang = 'en' THEN '' ELSE 'https://data.qdr.syr.edu/api/access/datafile/' || recid END
                     || '|https://data.qdr.syr.edu/api/access/datafile/' || recid AS urls,
                   CASE WHEN lang <> 'en' THEN '' WHEN n_chars > 500 THEN 'Embargoed until 2030-01-01' ELSE 'Restricted access' END AS reasons,
                   term AS query_string
            FROM {_sql_first('is_strict OR score >= 10', True)})""",
)
def read_dataverse(spark, sf):
    kept = _accepted(dataverse_landing(spark, sf), "qdr")
    return kept.select(
        "doi", "project_identifier",
        F.array_join("creators.name", "|").alias("creators"),
        "description",
        _names().alias("files"),
        F.array_join(F.col("files.tier").cast("array<string>"), "|").alias("tiers"),
        F.array_join("files.file_url", "|").alias("urls"),
        F.array_join("files.failure_reason", "|").alias("reasons"),
        "query_string",
    )


# --- ICPSR --------------------------------------------------------------------


def icpsr_landing(spark, sf):
    docs = _docs(spark, sf)
    known = F.col("lang") == "en"
    item = _json(
        ID=F.when(known, F.col("doc_id")),
        STUDYQ=F.col("doc_id"),
        TITLE=F.col("source"),
        SUMMARY=F.array("text"),
        NOTES=F.array(F.lit("a note")),
        AUTHOR=F.array("lang", F.lit("B")),
        DATEUPDATED=F.lit("2024-05-06T07:08:09"),
        URL=F.when(known, F.concat(F.lit("https://i/"), "rec")),
    )
    return _listed(
        docs, item,
        '<html><script>var x = {searchResults : {"response":{"numFound":9,"docs":[',
        "]}} , searchConfig: {}}</script></html>",
    )


@query(
    "read_icpsr",
    f"""SELECT recid, source || '-' || recid AS project_identifier, lang || ', B' AS creators_text,
               '2024-05-06' AS upload_date, 'restricted' AS license_id,
               CASE WHEN lang = 'en' THEN 'https://i/' || recid
                    ELSE 'https://www.icpsr.umich.edu/web/ICPSR/studies/' || recid END AS files,
               term AS query_string
        FROM {_sql_first('score >= 10', True)}""",
)
def read_icpsr(spark, sf):
    kept = _accepted(icpsr_landing(spark, sf), "icpsr")
    return kept.select(
        "recid", "project_identifier", "creators_text", "upload_date", "license_id",
        _names().alias("files"), "query_string",
    )


# --- NADA ---------------------------------------------------------------------


def nada_landing(spark, sf):
    docs = _docs(spark, sf)
    idno = F.concat(F.lit("ID/"), "rec")
    item = _json(
        idno=idno, title=F.col("source"), subtitle=F.when(F.col("lang") == "en", "sub"), nation=F.col("lang")
    )
    search = _listed(docs, item, '{"result":{"rows":[', "]}}")
    producer = F.struct(F.col("lang").alias("name"), F.lit(None).cast("string").alias("role"))
    unnamed = F.struct(F.lit(None).cast("string").alias("name"), F.lit("x").alias("role"))
    detail = _answers(
        docs, "detail", idno,
        _json(
            dataset=F.struct(
                F.col("text").alias("abstract"),
                F.struct(F.struct(F.array(producer, unnamed).alias("producers")).alias("doc_desc")).alias("metadata"),
            )
        ),
    )
    listed = lambda title, name: F.struct(
        title.alias("title"), name.alias("filename"), F.concat(F.lit("https://n/"), "rec").alias("url")
    )
    none = F.lit(None).cast("string")
    resources = _answers(
        docs.filter(F.col("lang") != "es"), "resources", idno,
        _json(resources=F.array(listed(F.lit("t.pdf"), none), listed(F.lit("x"), F.lit("a.NVP")), listed(F.lit("q"), F.lit("b.csv")))),
    )
    return search.unionByName(detail).unionByName(resources)


@query(
    "read_nada",
    f"""SELECT 'ID/' || recid AS recid, source || '-ID-' || recid AS project_identifier,
               CASE WHEN lang = 'en' THEN 'sub' ELSE source END AS description,
               'DataFirst-Terms-of-Use' AS license_id, lang AS creators_text,
               lang || ':PRODUCER|:x' AS persons, 't.pdf|a.NVP' AS files, 'false|true' AS is_qda,
               term AS query_string
        FROM {_sql_first('is_strict OR score >= 10', False)} WHERE lang <> 'es'""",
)
def read_nada(spark, sf):
    kept = _accepted(nada_landing(spark, sf), "sada")
    persons = F.transform("persons", lambda p: F.concat_ws(":", p["name"], p["role"]))
    return kept.select(
        "recid", "project_identifier", "description", "license_id", "creators_text",
        F.array_join(persons, "|").alias("persons"),
        _names().alias("files"),
        F.array_join(F.col("files.is_qda").cast("array<string>"), "|").alias("is_qda"),
        "query_string",
    )


def _wild(landing):
    """The same responses, every listing once more as the answer to a wildcard."""
    listed = landing.filter("kind = 'search'").withColumns({"term": F.lit("*"), "term_rank": F.lit(-1)})
    return landing.unionByName(listed)


@query(
    "read_sada_wildcard",
    f"""SELECT DISTINCT 'ID/' || recid AS recid, '*' AS query_string FROM {_HITS} WHERE lang <> 'es'""",
)
def read_sada_wildcard(spark, sf):
    """A wildcard vouches for its hits in this catalog."""
    kept = _accepted(_wild(nada_landing(spark, sf)), "sada")
    return kept.select("recid", F.col("query_string"))


@query(
    "read_ihsn",
    f"""SELECT DISTINCT 'ID/' || recid AS recid, 'IHSN-Standard-Terms' AS license_id, '*' AS query_string
        FROM {_HITS} WHERE lang <> 'es' AND score >= 10""",
)
def read_ihsn(spark, sf):
    """In this one it does not: the score decides, at the first listing."""
    kept = _accepted(_wild(nada_landing(spark, sf)), "ihsn")
    return kept.select("recid", "license_id", "query_string")


# --- CESSDA -------------------------------------------------------------------


def cessda_landing(spark, sf):
    docs = _docs(spark, sf)
    text = _json(t=F.col("text"))
    item = F.concat(
        F.lit('{"id":"'),
        F.when(F.col("lang") == "en", "doi:1/").otherwise("c"), "rec",
        F.lit('","titleStudy":"'), "source", F.lit('","abstract":'),
        F.expr("substring(_t, 6, length(_t) - 6)"),
        F.lit(',"keywords":[{"term":"k"},{}],"creators":[{"name":"A"},"'), "lang",
        F.lit('"],"studyXmlSourceUrl":"https://c/'), "rec", F.lit('"}'),
    )
    return _listed(docs.withColumn("_t", text), item, '{"Results":[', "]}")


@query(
    "read_cessda",
    f"""SELECT CASE WHEN lang = 'en' THEN 'doi:1/' ELSE 'c' END || recid AS project_identifier,
               CASE WHEN lang = 'en' THEN 'doi:1/' || recid ELSE '' END AS doi,
               'A | ' || lang AS creators_text, 'CESSDA-External-Terms' AS license_id, text AS description,
               'Study hosted externally. Resource access: https://c/' || recid AS reason, term AS query_string
        FROM {_sql_first('is_strict OR score >= 10', False)}""",
)
def read_cessda(spark, sf):
    kept = _accepted(cessda_landing(spark, sf), "cessda")
    return kept.select(
        "project_identifier", "doi", "creators_text", "license_id", "description",
        F.array_join("files.failure_reason", "|").alias("reason"), "query_string",
    )


@query(
    "read_cessda_user_query",
    f"""SELECT CASE WHEN lang = 'en' THEN 'doi:1/' ELSE 'c' END || recid AS project_identifier, term AS query_string
        FROM {_sql_first('true', False)}""",
)
def read_cessda_user_query(spark, sf):
    """Whatever a query typed by the user lists is taken."""
    kept = _accepted(cessda_landing(spark, sf), "cessda", user_query=True)
    return kept.select("project_identifier", "query_string")


# --- OAI-PMH ------------------------------------------------------------------


def oai_landing(spark, sf, prefix):
    """Pages of fifty records; two records in a row share a file link."""
    docs = _docs(spark, sf)
    link = F.concat(F.lit("https://o/f"), F.floor(F.col("doc_id") / 2).cast("string"), F.lit(".qdpx?x=1"))
    rights = F.when(F.col("lang") == "en", "CC BY 4.0").when(F.col("lang") == "fr", "CC0").otherwise("all rights reserved")
    if prefix == "oai_dc":
        fields = [
            "<dc:title>", F.col("source"), " &amp; co</dc:title><dc:creator>A</dc:creator><dc:creator>", F.col("lang"),
            "</dc:creator><dc:identifier>", link, "</dc:identifier><dc:relation>https://o/p", F.col("rec"),
            "</dc:relation><dc:source>local</dc:source><dc:rights>", rights, "</dc:rights>",
        ]
        opening, closing = '<oai_dc:dc xmlns:oai_dc="urn:o" xmlns:dc="urn:d">', "</oai_dc:dc>"
    else:
        fields = [
            '<identifier identifierType="DOI">10.1/x</identifier><titles><title xml:lang="en">', F.col("source"),
            " &amp; co</title></titles><creators><creator><creatorName>A</creatorName></creator><creator><creatorName>",
            F.col("lang"), "</creatorName></creator></creators><rightsList><rights>", rights,
            '</rights></rightsList><alternateIdentifiers><alternateIdentifier alternateIdentifierType="URL">', link,
            "</alternateIdentifier></alternateIdentifiers>",
        ]
        opening, closing = '<resource xmlns="http://datacite.org/schema/kernel-4">', "</resource>"
    parts = [f if not isinstance(f, str) else F.lit(f) for f in fields]
    record = F.concat(
        F.lit("<record><header><identifier>oai:o.org:"), "rec", F.lit("</identifier></header><metadata>"),
        F.lit(opening), *parts, F.lit(closing), F.lit("</metadata></record>"),
    )
    pages = docs.select("doc_id", record.alias("record")).groupBy(
        F.floor(F.col("doc_id") / PAGE).cast("int").alias("page")
    ).agg(F.array_sort(F.collect_list(F.struct("doc_id", "record"))).alias("records"))
    body = F.concat(
        F.lit('<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>'),
        F.array_join("records.record", ""),
        F.lit("</ListRecords></OAI-PMH>"),
    )
    return conform(pages.select(F.lit("search").alias("kind"), "page", body.alias("body")), LANDING)


_SQL_OAI = """(SELECT doc_id, source, lang, 'https://o/f' || (doc_id // 2)::VARCHAR || '.qdpx?x=1' AS url,
                      'f' || (doc_id // 2)::VARCHAR || '.qdpx' AS file,
                      CASE lang WHEN 'en' THEN 'CC BY 4.0' WHEN 'fr' THEN 'CC0' END AS license_id,
                      row_number() OVER (PARTITION BY doc_id // 2 ORDER BY doc_id) AS rn
               FROM documents WHERE lang IN ('en', 'fr'))"""


@query(
    "read_oai_datacite",
    f"""SELECT 'oai:o.org:' || doc_id::VARCHAR AS recid, source || ' & co' AS title, 'A | ' || lang AS creators_text,
               license_id, file AS files, url AS urls, source || '-co-oaioorg' || doc_id::VARCHAR AS project_identifier
        FROM {_SQL_OAI} WHERE rn = 1""",
)
def read_oai_datacite(spark, sf):
    kept = _accepted(oai_landing(spark, sf, "oai_datacite"), "odum")
    return kept.select(
        "recid", "title", "creators_text", "license_id", _names().alias("files"),
        F.array_join("files.file_url", "|").alias("urls"), "project_identifier",
    )


@query(
    "read_oai_dc",
    f"""SELECT 'oai:o.org:' || doc_id::VARCHAR AS recid, source || ' & co' AS title, 'A | ' || lang AS creators_text,
               license_id, file AS files, url AS urls FROM {_SQL_OAI} WHERE rn = 1""",
)
def read_oai_dc(spark, sf):
    harvest = read_oai(oai_landing(spark, sf, "oai_dc"), "archive", "oai_dc")
    kept = accept(harvest, policy_for("odum"), store=stored)
    return kept.select(
        "recid", "title", "creators_text", "license_id", _names().alias("files"),
        F.array_join("files.file_url", "|").alias("urls"),
    )


# --- All of them, and archives --------------------------------------------------


@query(
    "accepted_per_source",
    f"""SELECT 'icpsr' AS context_repository, count(*)::BIGINT AS n_records FROM {_sql_first('score >= 10', True)}
        UNION ALL
        SELECT 'cessda', count(*)::BIGINT FROM {_sql_first('is_strict OR score >= 10', False)}
        UNION ALL
        SELECT 'odum', count(*)::BIGINT FROM {_SQL_OAI} WHERE rn = 1""",
)
def per_source(spark, sf):
    landings = {
        "icpsr": icpsr_landing(spark, sf),
        "cessda": cessda_landing(spark, sf),
        "odum": oai_landing(spark, sf, "oai_datacite"),
    }
    counts = [accepted_per_source(_accepted(landed, source)) for source, landed in landings.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _zip_pages(batches):
    for batch in batches:
        blobs = []
        for html, url in zip(batch["html"], batch["url"], strict=True):
            stream = io.BytesIO()
            with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("root/page.html", html)
                z.writestr("root/meta/url.txt" if url.startswith("https") else "url.txt", url)
            blobs.append(stream.getvalue())
        yield pd.DataFrame({"path": batch["path"], "content": blobs})


@query(
    "archive_members",
    """SELECT page_id::VARCHAR AS archive, CASE WHEN starts_with(url, 'https') THEN 'page.html' ELSE 'root/page.html' END AS member,
              octet_length(encode(html))::BIGINT AS size, true AS readable FROM pages
       UNION ALL
       SELECT page_id::VARCHAR, CASE WHEN starts_with(url, 'https') THEN 'meta/url.txt' ELSE 'url.txt' END,
              octet_length(encode(url))::BIGINT, true FROM pages""",
)
def members(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("path"), "html", "url")
    return archive_members(pages.mapInPandas(_zip_pages, "path string, content binary"))
