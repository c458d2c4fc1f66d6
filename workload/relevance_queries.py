"""Scores, term hits and what follows from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import dedupe, limits
from shelfmark.operators.filters import passes
from shelfmark.operators.phrases import phrase_join, term_hits
from shelfmark.operators.relevance import relevant, score_records
from workload.base import STRICT, TERMS, WEIGHTS, query, sql_score, sql_terms, sql_walk, table

_SCORE = sql_score("lower(text)")

# Every term hit of every document, with its score. ``recid`` is shared by exact
# copies, so a record turns up several times under one term as well.
_SQL_HITS = f"""
    SELECT d.source AS context_repository, md5(d.text) AS recid, t.term_rank::INT AS term_rank,
           t.term, t.is_strict, d.doc_id AS page, 0 AS pos, {sql_score('lower(d.text)')} AS score
    FROM documents d JOIN {sql_terms()} ON contains(lower(d.text), lower(t.term))"""


def scored_hits(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("context_repository"),
        F.md5("text").alias("recid"),
        F.col("doc_id").alias("page"),
        F.lit(0).alias("pos"),
        "text",
    )
    scored = score_records(docs, "text", WEIGHTS)
    keep = ["context_repository", "recid", "page", "pos", "score"]
    hits = term_hits(scored, "text", TERMS, keep)
    return hits.withColumn("is_strict", F.col("term").isin(STRICT))


@query("relevance_score", f"SELECT doc_id, source, {_SCORE}::INT AS score FROM documents")
def relevance_score(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return score_records(docs, "text", WEIGHTS).select("doc_id", "source", "score")


@query(
    "relevant_docs",
    f"""SELECT source, count(*)::BIGINT AS n_records FROM documents
        WHERE {_SCORE} >= 10 GROUP BY source""",
)
def relevant_docs(spark, sf):
    docs = table(spark, sf, "documents").select("source", "text")
    return relevant(docs, "text", WEIGHTS).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_records")
    )


@query(
    "matched_phrases",
    f"""SELECT doc_id, array_to_string(list_filter([{", ".join(
        f"CASE WHEN contains(lower(text), '{p}') THEN '{p}' END" for p in WEIGHTS)}],
        lambda x: x IS NOT NULL), '|') AS phrases FROM documents""",
)
def matched(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = score_records(docs, "text", WEIGHTS, matched="phrases")
    return scored.select("doc_id", F.array_join("phrases", "|").alias("phrases"))


@query(
    "term_hits",
    f"""SELECT d.doc_id, t.term_rank::INT AS term_rank, t.term
        FROM documents d JOIN {sql_terms()} ON contains(lower(d.text), lower(t.term))""",
)
def hits(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return term_hits(docs, "text", TERMS, ["doc_id"])


@query(
    "hits_per_term",
    f"""SELECT t.term, count(*)::BIGINT AS n_hits
        FROM documents d JOIN {sql_terms()} ON contains(lower(d.text), lower(t.term))
        GROUP BY t.term""",
)
def hits_per_term(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = term_hits(docs, "text", TERMS, [])
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n_hits"))


@query(
    "benchmark_phrase_hits",
    """SELECT d.doc_id, b.item_id FROM documents d
       JOIN benchmark b ON contains(lower(d.text), lower(b.text))""",
)
def benchmark_phrase_hits(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    items = table(spark, sf, "benchmark").withColumnRenamed("text", "phrase")
    return phrase_join(docs, "text", items, "doc_id", "item_id", "phrase")


_SQL_PAIRS = """SELECT DISTINCT d.doc_id, p.item_id FROM documents d
    JOIN ({terms}) p ON contains(lower(d.text), p.phrase)"""

# Every benchmark text twice under one id, once in capitals.
_SQL_LONG = "SELECT item_id, lower(text) AS phrase FROM benchmark"
# Short terms of the corpus: letters, pieces of words and pairs of words, some twice.
_SQL_SHORT = """SELECT item_id, lower(substr(text, 1, 1)) AS phrase FROM benchmark
    UNION ALL SELECT item_id + 1000, lower(split_part(text, ' ', 2)) FROM benchmark WHERE split_part(text, ' ', 2) <> ''
    UNION ALL SELECT item_id + 2000, lower(split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2)) FROM benchmark
        WHERE split_part(text, ' ', 2) <> ''"""


def _long_terms(spark, sf):
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("phrase"))
    return items.unionByName(items.withColumn("phrase", F.upper("phrase")))


def _short_terms(spark, sf):
    one, two = F.split_part("text", F.lit(" "), F.lit(1)), F.split_part("text", F.lit(" "), F.lit(2))
    items = table(spark, sf, "benchmark")
    letters = items.select("item_id", F.substring("text", 1, 1).alias("phrase"))
    words = items.filter(two != "").select((F.col("item_id") + 1000).alias("item_id"), two.alias("phrase"))
    pairs = items.filter(two != "").select(
        (F.col("item_id") + 2000).alias("item_id"), F.concat(one, F.lit(" "), two).alias("phrase")
    )
    return letters.unionByName(letters).unionByName(words).unionByName(pairs)


def _joined(spark, sf, terms, **bounds):
    """Documents twice, and terms twice: the pairs are distinct whichever way is taken."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return phrase_join(docs.unionByName(docs), "text", terms, "doc_id", "item_id", "phrase", **bounds)


@query("phrases_broadcast", _SQL_PAIRS.format(terms=_SQL_LONG))
def phrases_broadcast(spark, sf):
    return _joined(spark, sf, _long_terms(spark, sf))


@query("phrases_by_rarest_word", _SQL_PAIRS.format(terms=_SQL_LONG))
def phrases_by_rarest_word(spark, sf):
    return _joined(spark, sf, _long_terms(spark, sf), max_broadcast_bytes=0)


@query("phrases_folded", _SQL_PAIRS.format(terms=_SQL_SHORT))
def phrases_folded(spark, sf):
    return _joined(spark, sf, _short_terms(spark, sf), max_folded=10_000)


@query("phrases_by_vocabulary", _SQL_PAIRS.format(terms=_SQL_SHORT))
def phrases_by_vocabulary(spark, sf):
    return _joined(spark, sf, _short_terms(spark, sf), max_folded=0)


@query(
    "benchmark_sentence_hits",
    """WITH phrases AS (
           SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[.!?]\\s+')) AS phrase FROM benchmark)
       SELECT d.doc_id, p.phrase FROM documents d
       JOIN phrases p ON p.phrase <> '' AND contains(lower(d.text), p.phrase)""",
)
def benchmark_sentence_hits(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    phrases = (
        table(spark, sf, "benchmark")
        .select(F.explode(F.split(F.lower("text"), r"[.!?]\s+")).alias("phrase"))
        .distinct()
        .withColumn("phrase_id", F.col("phrase"))
    )
    found = phrase_join(docs, "text", phrases, "doc_id", "phrase_id", "phrase")
    return found.withColumnRenamed("phrase_id", "phrase")


@query(
    "strict_or_scored",
    f"""SELECT recid, term, page AS doc_id, score::INT AS score FROM ({_SQL_HITS})
        WHERE is_strict OR score >= 10""",
)
def strict_or_scored(spark, sf):
    kept = scored_hits(spark, sf).filter(passes(F.col("score"), F.col("is_strict")))
    return kept.select("recid", "term", F.col("page").alias("doc_id"), "score")


_KEY = ["context_repository", "recid"]


@query(
    "first_accepted",
    f"""SELECT context_repository, recid, min(term_rank * 1000000000000 + page)::BIGINT AS place
        FROM ({_SQL_HITS}) WHERE is_strict OR score >= 10 GROUP BY 1, 2""",
)
def first_accepted(spark, sf):
    ok = passes(F.col("score"), F.col("is_strict"))
    won = dedupe.first_accepted(scored_hits(spark, sf), _KEY, ok)
    return won.select(*_KEY, (F.col("term_rank") * 1000000000000 + F.col("page")).alias("place"))


@query(
    "first_seen",
    f"""WITH seen AS (
            SELECT *, row_number() OVER (PARTITION BY context_repository, recid
                                         ORDER BY term_rank, page) AS rn FROM ({_SQL_HITS}))
        SELECT context_repository, recid, (term_rank * 1000000000000 + page)::BIGINT AS place
        FROM seen WHERE rn = 1 AND (is_strict OR score >= 10)""",
)
def first_seen(spark, sf):
    ok = passes(F.col("score"), F.col("is_strict"))
    won = dedupe.first_seen(scored_hits(spark, sf), _KEY, ok)
    return won.select(*_KEY, (F.col("term_rank") * 1000000000000 + F.col("page")).alias("place"))


@query(
    "cap_per_source",
    f"""WITH won AS (
            SELECT context_repository, recid, min(term_rank * 1000000000000 + page) AS place
            FROM ({_SQL_HITS}) WHERE is_strict OR score >= 10 GROUP BY 1, 2),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY context_repository ORDER BY place) AS rn FROM won)
        SELECT context_repository, recid, place::BIGINT AS place FROM ranked WHERE rn <= 7""",
)
def cap_per_source(spark, sf):
    ok = passes(F.col("score"), F.col("is_strict"))
    won = dedupe.first_accepted(scored_hits(spark, sf), _KEY, ok)
    kept = limits.cap_per_source(won, 7)
    return kept.select(*_KEY, (F.col("term_rank") * 1000000000000 + F.col("page")).alias("place"))


@query(
    "cap_per_term",
    sql_walk(
        f"""SELECT context_repository, recid, term_rank, min(page) AS place
            FROM ({_SQL_HITS}) WHERE is_strict OR score >= 10 GROUP BY 1, 2, 3""",
        3,
    )
    + " SELECT context_repository, recid, term_rank::INT AS term_rank, place AS page FROM taken",
)
def cap_per_term(spark, sf):
    ok = passes(F.col("score"), F.col("is_strict"))
    passing = scored_hits(spark, sf).filter(ok)
    hits = dedupe.first_rows(passing, [*_KEY, "term_rank"], ["page", "pos"])
    kept = limits.cap_per_term(hits, 3)
    return kept.select(*_KEY, "term_rank", "page")


# A cap above the number that Spark itself limits before a shuffle, over all
# pairs of item and quantity place; some places are null and the ranks have gaps.
_SQL_LINES = """
    SELECT l_returnflag AS context_repository, l_orderkey * 10 + l_linenumber AS recid,
           CASE WHEN l_partkey % 11 > 0 THEN (l_partkey % 5) * 7 END AS term_rank,
           CASE WHEN l_orderkey % 13 > 0 THEN l_orderkey END AS page,
           l_orderkey * 10 + l_linenumber AS pos
    FROM lineitem"""


def _lines(spark, sf):
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("context_repository"),
        key.alias("recid"),
        F.when(F.col("l_partkey") % 11 > 0, (F.col("l_partkey") % 5) * 7).alias("term_rank"),
        F.when(F.col("l_orderkey") % 13 > 0, F.col("l_orderkey")).alias("page"),
        key.alias("pos"),
    )


@query(
    "cap_per_source_large",
    f"""SELECT context_repository, recid, term_rank, page FROM (
            SELECT *, row_number() OVER (PARTITION BY context_repository
                ORDER BY term_rank NULLS FIRST, page NULLS FIRST, pos) AS rn FROM ({_SQL_LINES}))
        WHERE rn <= 1500""",
)
def cap_per_source_large(spark, sf):
    return limits.cap_per_source(_lines(spark, sf), 1500).drop("pos")


@query(
    "cap_ties",
    """SELECT l_returnflag AS context_repository, n::INT AS n, count(*)::BIGINT AS n_kept,
              max(l_quantity)::DOUBLE AS last_place
       FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rn FROM lineitem),
            (VALUES (999), (1000), (1001), (1005), (50000)) AS t(n)
       WHERE rn <= n GROUP BY 1, 2""",
)
def cap_ties(spark, sf):
    """Every place is that of many rows, whole rows are there twice: the cap holds to the
    row on both sides of the size up to which Spark cuts before the shuffle."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("context_repository"),
        F.col("l_quantity").cast("double").alias("place"),
        (F.col("l_orderkey") % 50).alias("recid"),
    )
    kept = [
        limits.cap_per_group(lines, ["context_repository"], ["place"], n).withColumn("n", F.lit(n))
        for n in (999, 1000, 1001, 1005, 50000)
    ]
    return reduce(DataFrame.unionByName, kept).groupBy("context_repository", "n").agg(
        F.count(F.lit(1)).alias("n_kept"), F.max("place").alias("last_place")
    )


def _sql_walk_large(n: int) -> str:
    """The rounds of the walk, written out for the ranks in the lines."""
    steps = [f"hits AS ({_SQL_LINES} UNION ALL SELECT context_repository, recid, 35, page, pos FROM ({_SQL_LINES}) WHERE term_rank < 14)"]
    names = []
    for rank in ("IS NULL", "= 0", "= 7", "= 14", "= 21", "= 28", "= 35"):
        gone = "".join(
            f" AND NOT EXISTS (SELECT 1 FROM {t} g WHERE"
            f" g.context_repository = h.context_repository AND g.recid = h.recid)"
            for t in names
        )
        names.append(f"t{len(names)}")
        steps.append(f"""{names[-1]} AS (SELECT * EXCLUDE (rn) FROM (
            SELECT h.*, row_number() OVER (PARTITION BY context_repository
                ORDER BY page NULLS FIRST, pos) AS rn
            FROM hits h WHERE term_rank {rank}{gone}) WHERE rn <= {n})""")
    union = " UNION ALL ".join(f"SELECT * FROM {t}" for t in names)
    return "WITH " + ", ".join(steps) + f" SELECT context_repository, recid, term_rank, page FROM ({union})"


@query("cap_per_term_large", _sql_walk_large(1100))
def cap_per_term_large(spark, sf):
    lines = _lines(spark, sf)
    again = lines.filter("term_rank < 14").withColumn("term_rank", F.lit(35).cast("bigint"))
    return limits.cap_per_term(lines.unionByName(again), 1100).drop("pos")


@query(
    "search_terms",
    """SELECT term, len(string_split(term, ' '))::INT AS n_words, min(rank)::INT AS rank FROM (
           SELECT trim(p_name, '"') AS term, 0 AS rank FROM part
           UNION ALL SELECT trim(p_type, '"'), 1 FROM part
           UNION ALL SELECT trim(p_brand, '"'), 1 FROM part)
       GROUP BY 1, 2""",
)
def search_terms(spark, sf):
    from shelfmark.functions import clean_term, split_query, word_count

    part = table(spark, sf, "part")
    quoted = F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))
    both = F.concat_ws(" OR ", "p_type", "p_brand")
    strict = part.select(quoted.alias("term"), F.lit(0).alias("rank"))
    broad = part.select(F.explode(split_query(both)).alias("term"), F.lit(1).alias("rank"))
    # a union of term lists, distinct, the earlier list first
    terms = strict.unionByName(broad).withColumn("term", clean_term(F.col("term")))
    return terms.groupBy("term").agg(F.min("rank").alias("rank")).select(
        "term", word_count(F.col("term")).alias("n_words"), "rank"
    )
