"""Ranked search against plain scoring of every document."""

from __future__ import annotations

import random

import brute
import pytest
from brute import AWKWARD, frame

from shelfmark.llm import ranked_search
from shelfmark.llm.ranked_search import search, sketches

CLASHES = ("n", "spots", "counts", "spare", "query", "queries", "bound", "score", "rank", "term", "df", "item_id")


def items_frame(spark, items):
    rows = spark.createDataFrame(items, "item_id long, text string")
    return rows.selectExpr("*", "CAST(NULL AS STRING) AS doc_id", "1 AS score")


def corpus(seed, n):
    """Few words, so ties are many; one text a third of all rows; repeated ids."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "漢字", "X1", "a", "the"]
    docs = [(i * 3 % 401, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(1000 - i, "The W1 the w2, copied text.") for i in range(n // 2)]
    docs += [(5, "w1 w1 w1"), (5, "w1 w2"), (5, "w1 w1 w1"), (7, "zz " * 400), (None, "w1 w2 w3"), (9, "zz")]
    return docs, words


@pytest.mark.parametrize(("seed", "coordinates", "k"), [(1, 1 << 16, 20), (2, 16, 5), (3, 1, 3)])
def test_against_brute_force(spark, monkeypatch, seed, coordinates, k):
    """With few coordinates the bounds are loose, and many rounds follow."""
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(ranked_search, "FIRST", 1)
    docs, words = corpus(seed, 120)
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(12)]
    items += [(3, "w1"), (None, "the THE été"), (50, None), (51, " ,. "), (52, "nowhere"), (53, "zz"), (54, "copied w1")]
    got = search(frame(spark, docs, CLASHES).repartition(5), items_frame(spark, items), k, coordinates)
    mine = sorted((tuple(r) for r in got.collect()), key=str)
    assert mine == sorted(brute.ranked_search(docs, items, k), key=str)


def test_awkward(spark):
    items = [(1, "a shared line of text"), (2, "w1x1 w2x4 tail"), (3, "mit license")]
    got = search(frame(spark, AWKWARD, CLASHES), items_frame(spark, items))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        brute.ranked_search(AWKWARD, items, 20), key=str
    )


def test_no_rows(spark):
    some, none = [(1, "a b")], []
    for docs, items in ((some, none), (none, some), (none, none), ([(1, None)], some)):
        assert search(frame(spark, docs), items_frame(spark, items)).collect() == []


def test_copies_are_spared(spark):
    docs = [(i, "Copied text" if i % 2 else f"text {i}") for i in range(400)]
    rows = sketches(frame(spark, docs).coalesce(1), k=20).collect()
    assert sum(not r.spare for r in rows) == 220
