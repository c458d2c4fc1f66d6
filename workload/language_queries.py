"""The trained language model on the documents: fitted to two thirds, tried on all."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators.language import fill_language_by_model, fit_languages, score_languages
from workload.base import query, table

_LANGUAGES = ["de", "en", "es", "fr"]
_TOP = 2000
_FITTED = "doc_id % 3 <> 1"


def _sql_weight(i: int) -> str:
    return f"floor(1000.0::DOUBLE * ln((c{i} + 1)::DOUBLE / (t{i} + v)::DOUBLE))::BIGINT AS w{i}"


_COUNTS = ", ".join(
    f"coalesce(sum(n) FILTER (lang = '{lang}'), 0)::BIGINT AS c{i}" for i, lang in enumerate(_LANGUAGES)
)
_BEST = f"greatest({', '.join(f's{i}' for i in range(len(_LANGUAGES)))})"
_GUESS = "CASE " + " ".join(f"WHEN s{i} = {_BEST} THEN '{lang}'" for i, lang in enumerate(_LANGUAGES)) + " END"
_SORTED = f"list_sort([{', '.join(f's{i}' for i in range(len(_LANGUAGES)))}], 'DESC')"
_SQL_GUESSED = f"""words AS (
        SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\\p{{L}}{{1,32}}')) AS word FROM documents),
    counted AS (SELECT doc_id, lang, word, count(*) AS n FROM words GROUP BY ALL),
    opened AS (SELECT doc_id, lang, n, substr(' ' || word || ' ', unnest(generate_series(1, length(word))), 3) AS gram
               FROM counted),
    per_lang AS (SELECT lang, gram, sum(n) AS n FROM opened WHERE {_FITTED} GROUP BY ALL),
    chosen AS (SELECT DISTINCT gram FROM (
        SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM per_lang) WHERE r <= {_TOP}),
    wide AS (SELECT gram, {_COUNTS} FROM per_lang SEMI JOIN chosen USING (gram) GROUP BY gram),
    totals AS (SELECT count(*) AS v, {", ".join(f"sum(c{i}) AS t{i}" for i in range(len(_LANGUAGES)))} FROM wide),
    model AS (SELECT gram, {", ".join(_sql_weight(i) for i in range(len(_LANGUAGES)))} FROM wide, totals),
    sums AS (SELECT doc_id, sum(n)::BIGINT AS n, {", ".join(f"sum(n * w{i})::BIGINT AS s{i}" for i in range(len(_LANGUAGES)))}
             FROM opened JOIN model USING (gram) GROUP BY doc_id),
    guessed AS (SELECT doc_id, {_GUESS} AS guess,
                       floor(({_SORTED}[1] - {_SORTED}[2])::DOUBLE / n)::BIGINT AS margin FROM sums)"""


def _model(docs):
    return fit_languages(docs.where(F.expr(_FITTED)), "text", "lang", _LANGUAGES, top=_TOP)


@query("language_model", f"WITH {_SQL_GUESSED} SELECT doc_id, guess, margin FROM guessed")
def language_model(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return score_languages(docs, "doc_id", "text", _model(docs))


@query(
    "language_model_accuracy",
    f"""WITH {_SQL_GUESSED}
        SELECT NOT ({_FITTED}) AS held_out, lang, guess, count(*)::BIGINT AS n_docs
        FROM documents LEFT JOIN guessed USING (doc_id) GROUP BY ALL""",
)
def language_model_accuracy(spark, sf):
    """How often the guess is the language the row carries, apart for rows not fitted to."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    guessed = score_languages(docs, "doc_id", "text", _model(docs)).select("doc_id", "guess")
    return (
        docs.select("doc_id", "lang", (~F.expr(_FITTED)).alias("held_out")).join(guessed, "doc_id", "left")
        .groupBy("held_out", "lang", "guess").agg(F.count(F.lit(1)).alias("n_docs"))
    )


@query(
    "language_model_fill",
    f"""WITH {_SQL_GUESSED}
        SELECT doc_id, CASE WHEN {_FITTED} THEN lang ELSE guess END AS language
        FROM documents LEFT JOIN guessed USING (doc_id)""",
)
def language_model_fill(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    unknown = docs.withColumn("language", F.when(F.expr(_FITTED), F.col("lang"))).drop("lang")
    filled = fill_language_by_model(unknown, _model(docs), "doc_id", "text")
    return filled.select("doc_id", "language")
