"""Filling and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import quality
from shelfmark.operators.quality import STOP_WORDS
from workload.base import query, table


def _sql_votes(lang: str) -> str:
    words = ", ".join(f"'{w}'" for w in STOP_WORDS[lang])
    return f"len(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda w: w IN ({words})))"


_LANGS = list(STOP_WORDS)
_SQL_GUESS = (
    "(SELECT doc_id, lang, CASE WHEN greatest("
    + ", ".join(_LANGS)
    + ") = 0 THEN NULL "
    + " ".join(f"WHEN {k} = greatest({', '.join(_LANGS)}) THEN '{k}'" for k in _LANGS)
    + " END AS guess FROM (SELECT doc_id, lang, "
    + ", ".join(f"{_sql_votes(k)} AS {k}" for k in _LANGS)
    + " FROM documents))"
)


@query(
    "language_guess",
    f"SELECT lang, guess, count(*)::BIGINT AS n_docs FROM {_SQL_GUESS} GROUP BY 1, 2",
)
def language_guess(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "text")
    guessed = quality.guess_language(docs, "text")
    return guessed.groupBy("lang", "guess").agg(F.count(F.lit(1)).alias("n_docs"))


@query(
    "language_fill",
    f"SELECT doc_id, CASE WHEN lang = 'en' THEN guess ELSE lang END AS language FROM {_SQL_GUESS}",
)
def language_fill(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("description"),
        F.nullif("lang", F.lit("en")).alias("language"),
    )
    return quality.fill_language(docs).select("doc_id", "language")


@query(
    "description_fill",
    """SELECT page_id, CASE WHEN contains(url, '?') THEN html WHEN contains(url, 'blog') THEN url
                            ELSE 'page, ' || page_id::VARCHAR END AS description FROM pages""",
)
def description_fill(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id",
        F.when(F.contains("url", F.lit("?")), F.col("html")).otherwise(" ").alias("description"),
        F.when(F.contains("url", F.lit("blog")), F.col("url")).alias("title"),
        F.array(F.lit("page"), F.col("page_id").cast("string")).alias("keywords"),
    )
    filled = quality.fill_description(pages, keywords="keywords")
    return filled.select("page_id", "description")


_PROFILED = ["doc_id", "text", "lang", "source", "n_chars"]


@query(
    "profile_documents",
    " UNION ALL ".join(
        f"""SELECT 'documents' AS table_name, '{c}' AS column_name, count(*)::BIGINT AS n_rows,
            (count(*) - count({c}))::BIGINT AS n_null, (count(*) FILTER ({c}::VARCHAR = ''))::BIGINT AS n_blank,
            count(DISTINCT {c})::BIGINT AS n_distinct, (count({c}) - count(DISTINCT {c}))::BIGINT AS n_duplicate
            FROM documents"""
        for c in _PROFILED
    ),
)
def profile_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.profile(docs, "documents", _PROFILED, long_text=["text"], exact=True)


@query(
    "profile_approximate",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*)::BIGINT AS n_rows, (count(*) - count({c}))::BIGINT AS n_null,
            true AS near_exact FROM documents"""
        for c in _PROFILED
    ),
)
def profile_approximate(spark, sf):
    """The estimates lie within three standard errors (5 % each) of the exact counts."""
    docs = table(spark, sf, "documents")
    rough = quality.profile(docs, "documents", _PROFILED)
    exact = quality.profile(docs, "documents", _PROFILED, long_text=["text"], exact=True)
    exact = exact.select("column_name", F.col("n_distinct").alias("n_exact"))
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    return rough.join(exact, "column_name").select(
        "column_name", "n_rows", "n_null", (off <= 0.15 * F.col("n_exact")).alias("near_exact")
    )


@query(
    "virtual_files",
    """SELECT page_id, 'external_study.url' AS file_key, url AS file_url, false AS restricted FROM pages""",
)
def virtual_files(spark, sf):
    notice = F.struct(
        F.lit("EXTERNAL_REPOSITORY_NOTICE.txt").alias("file_key"),
        F.lit("https://datacatalogue.cessda.eu").alias("file_url"),
        F.lit(True).alias("restricted"),
        F.concat(F.lit("Study hosted externally. Resource access: "), "url").alias("failure_reason"),
    )
    records = table(spark, sf, "pages").select("page_id", F.array(notice).alias("files"))
    shown = quality.virtual_files(records).select("page_id", F.inline("files"))
    return shown.select("page_id", "file_key", "file_url", "restricted")
