"""Text and record-field functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import (
    chunk_start,
    date_part,
    date_range_chunks,
    date_range_slices,
    failure_reason,
    flatten_json,
    format_authors,
    is_open_license,
    keyword_set,
    map_license,
    person_roles,
    project_identifier,
    slugify,
    xml_to_json,
)
from shelfmark.functions.records import OPEN_LICENSE
from shelfmark.operators.filters import recent
from workload.base import query, table


def sql_slug(text: str, n: int = 80, empty: str = "untitled_project") -> str:
    kept = rf"regexp_replace({text}, '[^\p{{L}}\p{{N}}_\s-]', '', 'g')"
    cut = rf"lower(substring(trim(regexp_replace({kept}, '[\s-]+', '-', 'g'), '-'), 1, {n}))"
    return f"coalesce(nullif({cut}, ''), '{empty}')"


@query(
    "slug_titles",
    f"SELECT doc_id, {sql_slug('text')} AS slug, {sql_slug('text', 40, 'untitled')} AS short_slug FROM documents",
)
def slug_titles(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        slugify(F.col("text")).alias("slug"),
        slugify(F.col("text"), 40, "untitled").alias("short_slug"),
    )


@query(
    "project_identifiers",
    f"""SELECT page_id, substring({sql_slug('html')} || '-' || translate(url, '/:', '--'), 1, 120) AS ident,
               {sql_slug('html')} || '-' || page_id::VARCHAR AS uncut
        FROM pages""",
)
def project_identifiers(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id",
        project_identifier(F.col("html"), F.translate("url", "/:", "--")).alias("ident"),
        project_identifier(F.col("html"), F.col("page_id").cast("string"), None).alias("uncut"),
    )


@query(
    "open_license",
    f"""SELECT doc_id, coalesce(regexp_matches(lower(text), '{OPEN_LICENSE}'), false) AS is_open
        FROM documents""",
)
def open_license(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", is_open_license(F.col("text")).alias("is_open"))


@query(
    "license_map",
    """SELECT mapped, count(*)::BIGINT AS n_lines FROM (
           SELECT CASE WHEN contains(lower(line), 'cc0') OR contains(lower(line), 'cc-zero') THEN 'cc0'
                       WHEN contains(lower(line), 'cc-by') THEN 'cc-by' ELSE line END AS mapped
           FROM (SELECT replace(line, 'CC BY', 'CC-BY') AS line
                 FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
                 WHERE regexp_matches(line, '[Ll]icense')))
       GROUP BY mapped""",
)
def license_map(spark, sf):
    # a look at each line; one regex over the text would back up at every character
    lines = F.filter(F.split("text", "\n"), lambda t: t.rlike("[Ll]icense"))
    named = table(spark, sf, "documents").select(F.explode(lines).alias("line"))
    mapped = map_license(F.replace("line", F.lit("CC BY"), F.lit("CC-BY")))
    return named.groupBy(mapped.alias("mapped")).agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    "author_lists",
    """SELECT c_custkey, trim(c_mktsegment) || ', ' || c_name || ' | ' || c_name AS authors FROM customer""",
)
def author_lists(spark, sf):
    def author(first, last):
        return F.struct(first.alias("firstName"), last.alias("lastName"))

    name = F.col("c_name")
    people = F.array(
        author(F.concat(name, F.lit(" ")), F.col("c_mktsegment")),
        author(F.lit(""), F.lit(" ")),
        author(name, F.lit("")),
    )
    return table(spark, sf, "customer").select("c_custkey", format_authors(people).alias("authors"))


@query(
    "keyword_sets",
    """SELECT p_partkey, array_to_string(list_sort(list_distinct(
           string_split(p_name, ' ') || [lower(p_type), p_brand])), '|') AS keywords FROM part""",
)
def keyword_sets(spark, sf):
    chunks = F.array(
        F.translate("p_name", " ", ","),
        F.concat(F.lower("p_type"), F.lit(" , "), F.col("p_brand"), F.lit(",")),
        F.split_part("p_name", F.lit(" "), F.lit(1)),
    )
    kept = F.array_join(F.array_sort(keyword_set(chunks)), "|")
    return table(spark, sf, "part").select("p_partkey", kept.alias("keywords"))


@query(
    "people_roles",
    """SELECT CASE WHEN role = 'user' THEN 'OWNER' WHEN role = 'system' THEN 'AUTHOR' ELSE 'OTHER' END AS role,
              count(*)::BIGINT AS n_people, count(DISTINCT conv_id)::BIGINT AS n_projects
       FROM conversations WHERE text <> '' GROUP BY 1""",
)
def people_roles(spark, sf):
    turns = table(spark, sf, "conversations")
    role = F.when(F.col("role") == "user", "owner").when(F.col("role") != "system", F.col("role"))
    person = F.struct(F.col("text").alias("name"), role.alias("role"))
    people = turns.select("conv_id", F.inline(person_roles(F.array(person))))
    return people.groupBy("role").agg(
        F.count(F.lit(1)).alias("n_people"), F.count_distinct("conv_id").alias("n_projects")
    )


@query(
    "failure_reasons",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN 'Restricted access'
                   ELSE 'Embargoed until ' || strftime(o_orderdate, '%Y-%m-%d') END AS reason,
              count(*)::BIGINT AS n FROM orders GROUP BY 1""",
)
def failure_reasons(spark, sf):
    orders = table(spark, sf, "orders")
    date = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return orders.groupBy(failure_reason(date).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "metadata_text",
    """SELECT event_id, event_type || ' ' || (props::JSON->>'$.k') || ' "' || user_id::VARCHAR || '\\' AS flat
       FROM events""",
)
def metadata_text(spark, sf):
    quoted = F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit("\\"))
    nested = F.to_json(
        F.struct(
            "event_type",
            F.from_json("props", "struct<k bigint>").alias("props"),
            F.array(quoted).alias("users"),
        )
    )
    return table(spark, sf, "events").select("event_id", flatten_json(nested).alias("flat"))


@query(
    "json_props",
    """SELECT event_type, sum((props::JSON->>'$.k')::BIGINT)::BIGINT AS total, count(*)::BIGINT AS n
       FROM events GROUP BY 1""",
)
def json_props(spark, sf):
    k = F.from_json("props", "struct<k bigint>")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.sum(k).alias("total"), F.count(F.lit(1)).alias("n")
    )


@query(
    "xml_elements",
    """SELECT s_suppkey, '{"name":"' || s_name || '","tag":["' || s_nationkey::VARCHAR || '","x"],"inner":{"city":"c' ||
              s_nationkey::VARCHAR || '"}}' AS js FROM supplier""",
)
def xml_elements(spark, sf):
    nation = F.col("s_nationkey").cast("string")
    xml = F.concat(
        F.lit('<r xmlns:a="u"><a:name lang="en"> '), F.col("s_name"),
        F.lit(" </a:name><tag>"), nation, F.lit("</tag><tag>x</tag><inner><city>c"),
        nation, F.lit("</city></inner></r>"),
    )
    schema = "name string, tag array<string>, inner struct<city string>"
    return table(spark, sf, "supplier").select("s_suppkey", xml_to_json(xml, schema).alias("js"))


@query(
    "date_parts",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS n FROM events GROUP BY 1""",
)
def date_parts(spark, sf):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").groupBy(date_part(iso).alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "recent_window",
    """SELECT event_type, count(*)::BIGINT AS n FROM events
       WHERE ts::DATE BETWEEN DATE '2024-02-10' - 30 AND DATE '2024-02-10' GROUP BY 1""",
)
def recent_window(spark, sf):
    import datetime as dt

    events = table(spark, sf, "events").filter(recent(F.col("ts"), dt.date(2024, 2, 10)))
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_chunks",
    """WITH RECURSIVE lim AS (SELECT max(o_orderdate)::DATE AS until FROM orders),
       starts(s) AS (SELECT DATE '1996-01-01' UNION ALL
                     SELECT (s + INTERVAL 5 MONTH)::DATE FROM starts, lim WHERE (s + INTERVAL 5 MONTH)::DATE < until),
       chunks AS (SELECT s AS chunk_start, least((s + INTERVAL 5 MONTH)::DATE - 1, until) AS chunk_end FROM starts, lim)
       SELECT strftime(chunk_start, '%Y-%m-%d') AS chunk_start, strftime(chunk_end, '%Y-%m-%d') AS chunk_end,
              (SELECT count(*) FROM orders WHERE o_orderdate::DATE BETWEEN chunk_start AND chunk_end)::BIGINT AS n_orders
       FROM chunks""",
)
def date_chunks(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    limits = orders.agg(F.max("day").alias("until"))
    chunks = date_range_chunks(limits, "until", 1996, 5)
    # orders find their chunk by its start; a chunk's end still excludes what
    # the last chunk does not cover
    per_day = (
        orders.filter(F.col("day") >= F.make_date(F.lit(1996), F.lit(1), F.lit(1)))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("chunk_start", chunk_start(F.col("day"), 1996, 5))
    )
    counted = chunks.join(per_day, "chunk_start", "left").groupBy("chunk_start", "chunk_end").agg(
        F.coalesce(F.sum(F.when(F.col("day") <= F.col("chunk_end"), F.col("n"))), F.lit(0)).alias("n_orders")
    )
    day = "yyyy-MM-dd"
    return counted.select(
        F.date_format("chunk_start", day).alias("chunk_start"),
        F.date_format("chunk_end", day).alias("chunk_end"),
        "n_orders",
    )


@query(
    "date_slices",
    """SELECT o_orderpriority, i::INT AS slice,
              strftime(lo + (days * i // 7)::INT, '%Y-%m-%d') AS slice_start,
              strftime(CASE WHEN i = 6 THEN hi ELSE lo + (days * (i + 1) // 7)::INT END, '%Y-%m-%d') AS slice_end
       FROM (SELECT o_orderpriority, min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi,
                    date_diff('day', min(o_orderdate)::DATE, max(o_orderdate)::DATE) AS days
             FROM orders GROUP BY 1), range(7) r(i)""",
)
def date_slices(spark, sf):
    limits = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )
    day = "yyyy-MM-dd"
    return date_range_slices(limits, "lo", "hi", 7).select(
        "o_orderpriority",
        "slice",
        F.date_format("slice_start", day).alias("slice_start"),
        F.date_format("slice_end", day).alias("slice_end"),
    )
