"""Links of raw pages: file names, project links, URLs seen before."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import absolute_href, file_ext, has_project_link, link_file_name
from shelfmark.functions.files import link_pattern
from shelfmark.operators.dedupe import fresh_file_urls, unseen
from shelfmark.operators.joins import known_project_urls
from shelfmark.sources.icpsr import embedded_json
from workload.base import query, table

_HREF = 'href="([^"]*)"'
_HOST = "https://pages.example.org"
_LINK_EXT = [".html", ".php", ".net", ".com"]

_SQL_LINKS = f"""
    SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) - 1 AS pos
    FROM (SELECT page_id, list_transform(regexp_extract_all(html, '{_HREF}', 1) || [url],
                 lambda h: CASE WHEN starts_with(h, 'http') THEN h ELSE '{_HOST}' || h END) AS l FROM pages)"""


def links(spark, sf):
    pages = table(spark, sf, "pages")
    hrefs = F.concat(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)), F.array("url"))
    absolute = F.transform(hrefs, lambda h: absolute_href(h, _HOST))
    return pages.select("page_id", absolute.alias("links"))


@query(
    "links_in_pages",
    f"""SELECT page_id, pos::INT AS pos, link,
               coalesce(nullif(split_part(split_part(link, '/', -1), '?', 1), ''), 'resource_link') AS name
        FROM ({_SQL_LINKS})""",
)
def links_in_pages(spark, sf):
    rows = links(spark, sf).select("page_id", F.posexplode("links").alias("pos", "link"))
    return rows.select("page_id", "pos", "link", link_file_name(F.col("link")).alias("name"))


_RE2 = link_pattern(_LINK_EXT)


@query(
    "qda_links",
    f"""SELECT page_id, regexp_matches(lower(url), '{_RE2}') AS url_matches,
               regexp_matches(lower(html || ' ' || url), '{_RE2}') AS page_matches
        FROM pages""",
)
def qda_links(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id",
        has_project_link(F.col("url"), _LINK_EXT).alias("url_matches"),
        has_project_link(F.concat_ws(" ", "html", "url"), _LINK_EXT).alias("page_matches"),
    )


@query(
    "new_urls",
    """WITH stripped AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS base FROM pages)
       SELECT page_id, url AS project_url FROM stripped
       WHERE url NOT IN (SELECT base FROM stripped)""",
)
def new_urls(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("url").alias("project_url"))
    stored = pages.select(F.regexp_replace("project_url", "[?#].*$", "").alias("project_url"))
    return unseen(pages, known_project_urls(stored), ["project_url"])


@query(
    "seen_url_dedupe",
    f"""WITH e AS ({_SQL_LINKS}), own AS (SELECT link, min(page_id) AS page_id FROM e GROUP BY link)
        SELECT e.page_id, count(*)::BIGINT AS n_files, array_to_string(list(e.link ORDER BY e.pos), ' ') AS links
        FROM e JOIN own ON own.link = e.link AND own.page_id = e.page_id GROUP BY e.page_id""",
)
def seen_url_dedupe(spark, sf):
    records = links(spark, sf).select(
        "page_id",
        F.transform("links", lambda u: F.struct(u.alias("file_url"))).alias("files"),
    )
    kept = fresh_file_urls(records, ["page_id"], [])
    return kept.select(
        "page_id",
        F.size("files").cast("bigint").alias("n_files"),
        F.array_join("files.file_url", " ").alias("links"),
    )


@query(
    "page_embedded_json",
    r"""SELECT page_id, regexp_extract(html, '(?s)track\s*\(\s*(.*?)\s*\)\s*;</script>', 1) AS block FROM pages""",
)
def page_embedded_json(spark, sf):
    pages = table(spark, sf, "pages")
    block = embedded_json(F.col("html"), r"(?s)track\s*\(\s*(.*?)\s*\)\s*;</script>")
    return pages.select("page_id", F.coalesce(block, F.lit("")).alias("block"))


@query(
    "link_extensions",
    f"""SELECT CASE WHEN contains(name, '.') THEN '.' || lower(split_part(name, '.', -1)) ELSE '' END AS ext,
               count(*)::BIGINT AS n_links
        FROM (SELECT split_part(split_part(link, '/', -1), '?', 1) AS name FROM ({_SQL_LINKS})) GROUP BY 1""",
)
def link_extensions(spark, sf):
    rows = links(spark, sf).select(F.explode("links").alias("link"))
    ext = file_ext(link_file_name(F.col("link")))
    return rows.groupBy(ext.alias("ext")).agg(F.count(F.lit(1)).alias("n_links"))
