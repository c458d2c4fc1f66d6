"""Language of a text by a model of letter n-grams, fitted to rows whose language is known.

A model is a table: one row per n-gram with a whole-number weight for each language, the
smoothed logarithm of how likely the n-gram is there. N-grams are counted and summed up
beside the texts, in tasks: most words are rare, so a table of words or of n-grams per text
would be larger than the texts. A text gets the language with the largest sum of weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import null_if_blank
from shelfmark.session import stored

#: A run of letters; a longer one is read in pieces, so no word costs more than others.
WORD = r"\p{L}{1,32}"
SCALE = 1000
#: Characters handled at once inside a task.
CHUNK = 1 << 19


class LanguageModel(NamedTuple):
    """``weights``: ``gram`` and one column per language, ``w0``, ``w1``, ..."""

    weights: DataFrame
    languages: tuple[str, ...]
    n: int


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word between two blanks; a shorter one is a gram as a whole."""
    padded = f" {word} "
    return [padded[i : i + n] for i in range(max(len(padded) - n, 0) + 1)]


def _pieces(texts: list[str]) -> Iterator[slice]:
    """Runs of texts with about ``CHUNK`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts, each between two blanks, and where each text starts."""
    padded = [f" {t} " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.int64)
    return points, np.cumsum([0, *map(len, padded[:-1])])


def _counts(texts: list[str], n: int) -> Iterator[tuple[str, int]]:
    """Every n-gram of the texts, words joined by blanks, with its number."""
    if n != 3:
        yield from Counter(g for t in texts for w in t.split() for g in grams_of(w, n)).items()
        return
    points, _ = _codes(texts)
    inner = points[1:-1] != 32  # a gram around a blank lies in two words
    grams = ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[inner]
    for gram, count in zip(*(x.tolist() for x in np.unique(grams, return_counts=True))):
        yield "".join(chr(gram >> k & 0x1FFFFF) for k in (42, 21, 0)), count


def _counted(texts: DataFrame, n: int) -> DataFrame:
    """``_lang, gram, _n`` of rows ``_lang, _words``: n-grams counted by pieces of batches,
    then as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, words in zip(*(c.to_pylist() for c in batch.columns)):
                by_lang.setdefault(lang, []).append(words or "")
            for lang, own in by_lang.items():
                for piece in _pieces(own):
                    grams, counts = [list(c) for c in zip(*_counts(own[piece], n))] or ([], [])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
                        names=["_lang", "gram", "_n"],
                    )

    counted = texts.mapInArrow(run, "_lang string, gram string, _n long")
    return counted.groupBy("_lang", "gram").agg(F.sum("_n").alias("_n"))


def fit_languages(
    labelled: DataFrame, text: str, language: str, languages: Sequence[str], n: int = 3, top: int = 2000
) -> LanguageModel:
    """A model of ``languages`` from all rows that carry one of them.

    Each language brings its ``top`` most frequent n-grams (of equal ones the first in
    order), so the model has at most ``len(languages) * top`` rows however many texts it
    is fitted to. Rows of no or another language, and null or empty texts, add nothing; a
    model fitted to no rows has none and guesses null.
    """
    languages = tuple(languages)
    known = labelled.where(F.col(language).isin(*languages))
    # stored: three jobs use it, and it is far smaller than the texts
    grams = stored(
        _counted(known.select(F.col(language).alias("_lang"), F.array_join(words_of(F.col(text)), " ").alias("_words")), n), "grams"
    )
    by_count = Window.partitionBy("_lang").orderBy(F.desc("_n"), "gram")
    chosen = grams.withColumn("_rank", F.row_number().over(by_count)).where(F.col("_rank") <= top)
    counts = [F.sum(F.when(F.col("_lang") == l, F.col("_n")).otherwise(0)).alias(f"c{i}") for i, l in enumerate(languages)]
    # at most len(languages) * top rows from here on
    wide = grams.join(F.broadcast(chosen.select("gram").distinct()), "gram").groupBy("gram").agg(*counts)
    totals = wide.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"t{i}") for i in range(len(languages))])

    def weight(i: int) -> Column:
        share = (F.col(f"c{i}") + 1).cast("double") / (F.col(f"t{i}") + F.col("v")).cast("double")
        return F.floor(F.lit(float(SCALE)) * F.ln(share)).cast("long").alias(f"w{i}")

    # one row of totals beside every n-gram
    weights = wide.join(F.broadcast(totals)).select("gram", *[weight(i) for i in range(len(languages))])
    return LanguageModel(weights, languages, n)


def _sums(model: LanguageModel):
    """Rows ``_key, _words`` to the number of known n-grams and their sums of weights;
    texts without one are left out."""
    names = [f"w{i}" for i in range(len(model.languages))]
    rows = model.weights.select("gram", *names).collect()  # as many as the model may have
    # an unknown n-gram meets the last row
    weights = np.array([*(r[1:] for r in rows), [0] * len(names)], np.int64).reshape(-1, len(names))
    n = model.n
    place = {r.gram: i for i, r in enumerate(rows)}
    letters = {c: k for k, c in enumerate(sorted({c for g in place for c in g}), 1)}
    base = len(letters) + 1

    def by_word(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [[place[g] for w in t.split() for g in grams_of(w, n) if g in place] for t in texts]
        return np.array([len(f) for f in found]), np.array([weights[f].sum(axis=0) for f in found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.zeros(0x110000, np.int64)
        for c, k in letters.items():
            numbers[ord(c)] = k
        coded = sorted(((letters[g[0]] * base + letters[g[1]]) * base + letters[g[2]], i) for g, i in place.items()) \
            if n == 3 else []
        keys, at = (np.array([c[k] for c in coded], np.int64) for k in (0, 1))

        def by_code(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            points, starts = _codes(texts)
            # two blanks part the texts, and no gram of the model has one inside
            own = np.concatenate([numbers[points], [0, 0]])
            grams = (own[:-2] * base + own[1:-1]) * base + own[2:]
            near = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            known = keys[near] == grams
            row = np.where(known, at[near], len(rows))
            return np.add.reduceat(known.astype(np.int64), starts), np.add.reduceat(weights[row], starts)

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for piece in _pieces(texts) if rows else ():
                counts, sums = (by_code if n == 3 else by_word)(texts[piece])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.start, piece.stop - piece.start), pa.array(counts, pa.int64()),
                     *(pa.array(sums[:, i], pa.int64()) for i in range(len(names)))],
                    names=["_key", "_n", *names],
                ).filter(pa.array(counts > 0))

    return run


def score_languages(df: DataFrame, key: str, text: str, model: LanguageModel) -> DataFrame:
    """``key``, ``guess`` and ``margin`` (the lead over the second language per n-gram
    known to the model, in thousandths of a unit of the logarithm) of every text with such
    an n-gram. Of equal sums the language first in the model's order wins. ``key`` tells
    the rows apart; rows with a null key or text are left out.

    Texts do not move: their n-grams meet the model, of bounded size, in place, and what is
    shuffled is one row of sums per text. The model is read when this is called.
    """
    texts = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.array_join(words_of(F.col(text)), " ").alias("_words"))
    met = texts.mapInArrow(
        _sums(model),
        ", ".join([f"_key {texts.schema['_key'].dataType.simpleString()}", "_n long",
                   *(f"w{i} long" for i in range(len(model.languages)))]),
    )
    sums = [F.sum(f"w{i}").alias(f"s{i}") for i in range(len(model.languages))]
    summed = met.groupBy("_key").agg(F.sum("_n").alias("_n"), *sums)
    places = F.array(*[
        F.struct(F.col(f"s{i}").alias("s"), F.lit(-i).alias("place"), F.lit(lang).alias("lang"))
        for i, lang in enumerate(model.languages)
    ])
    ranked = summed.withColumn("_ranked", F.sort_array(places, asc=False))
    lead = F.col("_ranked")[0]["s"] - F.try_element_at("_ranked", F.lit(2))["s"]
    return ranked.select(
        F.col("_key").alias(key),
        F.col("_ranked")[0]["lang"].alias("guess"),
        F.floor(lead / F.col("_n")).cast("long").alias("margin"),
    )


def fill_language_by_model(
    df: DataFrame, model: LanguageModel, key: str = "id", text: str = "description", language: str = "language"
) -> DataFrame:
    """Fill a null or blank language from the text; others stay, as do rows whose text
    has nothing the model knows (their language becomes null). Only texts without a
    language are opened. ``key`` is unique; a row without a key is not filled."""
    bare = df.where(null_if_blank(F.col(language)).isNull())
    guessed = score_languages(bare, key, text, model).select(key, F.col("guess").alias("_guess"))
    filled = F.coalesce(null_if_blank(F.col(language)), F.col("_guess"))
    joined = df.join(guessed, key, "left").withColumn(language, filled)
    return joined.select(*df.columns)
