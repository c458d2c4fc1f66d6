"""Relevance score of a text against weighted phrases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.once import once
from shelfmark.taxonomy import PHRASE_WEIGHTS, RELEVANCE_THRESHOLD


def _balanced_sum(parts: Sequence[Column]) -> Column:
    """Sum as a balanced tree; a left-deep one is as deep as the vocabulary."""
    parts = list(parts)
    while len(parts) > 1:
        parts = [
            parts[i] + parts[i + 1] if i + 1 < len(parts) else parts[i]
            for i in range(0, len(parts), 2)
        ]
    return parts[0]


def relevance_score(lowered: Column, weights: Mapping[str, int] = PHRASE_WEIGHTS) -> Column:
    """Sum of the weights of the distinct phrases inside a lower-cased text.

    Presence counts, not frequency; a phrase nested in another counts as well.
    """
    if not weights:
        return F.lit(0)
    parts = [
        F.contains(lowered, F.lit(phrase)).cast("int") * F.lit(weight)
        for phrase, weight in weights.items()
    ]
    return F.coalesce(_balanced_sum(parts), F.lit(0))


def matched_phrases(lowered: Column, phrases: Sequence[str]) -> Column:
    """The phrases inside a lower-cased text, in vocabulary order."""
    found = [F.when(F.contains(lowered, F.lit(p)), F.lit(p)) for p in phrases]
    return F.array_compact(F.array(*found))


def score_records(
    records: DataFrame,
    text: str | Column,
    weights: Mapping[str, int] = PHRASE_WEIGHTS,
    score: str = "score",
    matched: str | None = None,
) -> DataFrame:
    """Add ``score`` and, if named, the array of matched phrases.

    The text is lower-cased once and searched once per phrase, also when the
    result is filtered by the score.
    """
    text = F.col(text) if isinstance(text, str) else text
    lowered = records.withColumn("_lowered", F.lower(text))
    if not matched:
        return once(lowered, **{score: relevance_score(F.col("_lowered"), weights)}).drop("_lowered")
    found = matched_phrases(F.col("_lowered"), list(weights))
    listed = once(lowered, **{matched: F.coalesce(found, F.array().cast("array<string>"))})
    # the few phrases found carry the score
    weight_of = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    total = F.aggregate(
        matched, F.lit(0), lambda sum_, phrase: sum_ + F.try_element_at(weight_of, phrase)
    )
    return listed.withColumn(score, total).drop("_lowered")


def relevant(
    records: DataFrame,
    text: str | Column,
    weights: Mapping[str, int] = PHRASE_WEIGHTS,
    threshold: int = RELEVANCE_THRESHOLD,
    score: str = "score",
) -> DataFrame:
    scored = score_records(records, text, weights, score)
    return scored.filter(F.col(score) >= threshold)
