"""The fitted language model: held-out accuracy, plain sums, and odd rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import quality
from shelfmark.operators.language import fill_language_by_model, fit_languages, score_languages

ROWS = [
    (1, "aa", "abab abba ab"),
    (2, "aa", "abba"),
    (3, "bb", "cdcd cd ab"),
    (4, None, "zzz"),
    (5, "xx", "qqq"),
    (6, "bb", None),
    (7, "aa", ""),
]


def fitted(spark, rows=ROWS, **options):
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    return fit_languages(df, "text", "lang", ["aa", "bb"], **options)


def plain_grams(text):
    words = re.findall(r"[^\W\d_]{1,32}", text.lower())
    return [f" {w} "[i : i + 3] for w in words for i in range(len(w))]


def test_weights_and_guesses_by_hand(spark):
    model = fitted(spark)
    counts = {lang: Counter(g for _, l, t in ROWS if l == lang for g in plain_grams(t or "")) for lang in ("aa", "bb")}
    grams = set(counts["aa"]) | set(counts["bb"])
    want = {
        g: tuple(
            math.floor(1000.0 * math.log((counts[l][g] + 1) / (sum(counts[l].values()) + len(grams)))) for l in ("aa", "bb")
        )
        for g in grams
    }
    assert {r.gram: (r.w0, r.w1) for r in model.weights.collect()} == want

    texts = ["abba cd", "cdcd, cd!", "zzz", "", None, "ab", "A"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.guess for r in score_languages(df, "id", "text", model).collect()}
    for i, text in enumerate(texts):
        known = [want[g] for g in plain_grams(text or "") if g in want]
        sums = [sum(w) for w in zip(*known)]
        assert got.get(i) == (None if not known else "aa" if sums[0] >= sums[1] else "bb")


def test_a_model_is_bounded_and_may_be_empty(spark):
    assert fitted(spark, top=2).weights.count() <= 4
    empty = fitted(spark, [])
    df = spark.createDataFrame([(1, "abba", None)], "id long, description string, language string")
    assert fill_language_by_model(df, empty).collect()[0].language is None


def test_fill_keeps_every_row(spark):
    rows = [(1, "abba", None, "x"), (2, "cdcd cd", " ", "y"), (3, "abba", "fr", "z"), (None, "abba", None, "n"), (4, None, None, "v")]
    df = spark.createDataFrame(rows, "id long, description string, language string, guess string")
    filled = fill_language_by_model(df, fitted(spark))
    assert filled.columns == df.columns
    assert {r.guess: r.language for r in filled.collect()} == {"x": "aa", "y": "bb", "z": "fr", "n": None, "v": None}


def test_one_very_long_word_and_the_plan(spark):
    df = spark.createDataFrame([(1, "ab" * 200_000)], "id long, text string")
    scored = score_languages(df, "id", "text", fitted(spark))
    assert [r.guess for r in scored.collect()] == ["aa"]


def test_better_than_stop_words_on_rows_not_fitted_to(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = docs.where("doc_id % 3 = 1")
    model = fit_languages(docs.where("doc_id % 3 <> 1"), "text", "lang", ["de", "en", "es", "fr"])

    def right(guessed):
        return guessed.where(F.col("guess") == F.col("lang")).count()

    trained = right(held.join(score_languages(held, "doc_id", "text", model), "doc_id"))
    voted = right(quality.guess_language(held, "text"))
    total = held.count()
    print("held-out rows", total, "model", trained, "stop words", voted)
    assert trained >= voted and trained >= 0.95 * total


@pytest.mark.parametrize("n", [2, 3, 4])
def test_grams_are_those_of_the_words(spark, n, monkeypatch):
    """Counts and sums made by pieces of texts are those of the words taken one by one."""
    from shelfmark.operators import language

    monkeypatch.setattr(language, "CHUNK", 12)
    texts = ["der die das", "", "a é bb", "ñandú 𝒳y a", "x"]
    want = Counter(g for t in texts for w in t.split() for g in language.grams_of(w, n))
    got = Counter()
    for piece in language._pieces(texts):
        for gram, k in language._counts(texts[piece], n):
            got[gram] += k
    assert got == want
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("lang", F.lit("de"))
    model = language.fit_languages(docs, "text", "lang", ["de", "en"], n=n)
    weights = {r.gram: (r.w0, r.w1) for r in model.weights.collect()}
    assert set(weights) == set(want)
    wanted = {}
    for i, t in enumerate(texts):
        own = [weights[g] for w in t.split() for g in language.grams_of(w, n)]
        if own:
            s = [sum(w[k] for w in own) for k in (0, 1)]
            wanted[i] = ("de" if s[0] >= s[1] else "en", abs(s[0] - s[1]) // len(own))
    assert {r.id: (r.guess, r.margin) for r in language.score_languages(docs, "id", "text", model).collect()} == wanted
