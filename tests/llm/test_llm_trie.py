"""The prefix tree against a plain one, whatever bursts."""

from __future__ import annotations

import random

import brute
import pytest

from shelfmark.llm.prefix_trie import COLUMNS, prefix_trie, sweep, turns, with_borrowed_heads

CLASHES = ("pos", "id", "words", "rep", "n", "head", "depth", "parent", "base", "h", "len", "burst", "alone")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", *(f"CAST(NULL AS STRING) AS `{c}`" for c in CLASHES))


def check(spark, rows, **limit):
    got = prefix_trie(*with_borrowed_heads(turns(frame(spark, rows).repartition(3))), **limit)
    mine = sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)
    assert mine == sorted(brute.prefix_trie(brute.rebuilt(rows)), key=str)
    return mine


def conversations(seed):
    """Few texts, one common first turn, many equal conversations and a long one."""
    rng = random.Random(seed)
    rows = []
    for c in range(0, 130):
        base = rng.choice(["hello there", "hello there", "other  start\there"])
        said = [base] + [rng.choice("ab") + " b\n" * rng.randint(0, 1) for _ in range(rng.randint(0, 5))]
        if c % 3 == 0:
            said = ["hello there", "same", "for all"]
        rows += [(c, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(said)]
    rows += [(1000, i, "user", f"turn {i}") for i in range(300)]
    return rows


@pytest.mark.parametrize(("seed", "limit"), [(1, 8192), (2, 40), (3, 1)])
def test_against_plain_tree(spark, seed, limit):
    assert len(check(spark, conversations(seed), limit=limit)) > 300


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (1, None, "user", ""),
        (None, 0, "user", "nobody's"), (2, 3, "", "late"), (-7, 0, "user", "a"), (-21, 1, "user", "x y"),
        (-20, 0, "user", "base"), (40, 0, "a", "b"), (41, 0, "ab", ""), (41, 1, "a", "b"), (59, 0, "q", "w " * 50_000),
        (60, 0, "user", None), (80, None, None, None),
    ]
    for limit in (1, 8192):
        check(spark, rows, limit=limit)


def test_no_rows(spark):
    assert check(spark, []) == []
    assert check(spark, [(None, 1, "user", "x")]) == []


def test_sweep_keeps_its_top():
    nodes = sweep(b"h", 3, [(5, 2, []), (4, 1, [(b"x", 10)]), (9, 3, [(b"x", 10), (b"y", 1)])])
    assert nodes[-1] == [b"h", 3, 4, None, 6, 1, 1, 30 + 2, 5]
