"""Near copies against all pairs, and the stage that keeps one row of each component."""

from __future__ import annotations

import random
from collections import Counter

import brute
import corpus_pipeline as pipeline
import numpy as np
import pytest
from brute import AWKWARD, LOWER, frame

from shelfmark.llm.near_copies import near_copies, shingle_sets, similar_forest
from shelfmark.llm.simhash_dups import fingerprints_of


def shingles(text):
    w = brute.words((text or "").translate(LOWER))
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def edited(seed=11, n=120):
    """Texts with changed words: similarities on both sides of the threshold."""
    rng = random.Random(seed)
    base = [[f"w{rng.randint(0, 5000)}" for _ in range(k)] for k in (30, 80, 300, 900)]
    out = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, len(text) // 25)):
            text[rng.randrange(len(text))] = f"v{rng.randint(0, 99)}"
        out.append((i + 20, " ".join(text)))
    return out


def stayed(spark, docs):
    got = pipeline.drop_near_duplicates(spark, frame(spark, docs), "")
    return Counter((r.doc_id, r.text) for r in got.collect())


def wanted(docs):
    """One row of each component, by all pairs."""
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    roots = brute.groups([shingles(t) for _, t in docs], similar)
    return [docs[r] for r in sorted(set(roots))]


@pytest.mark.parametrize("part", [32 << 20, 4000])
def test_every_similar_pair_is_linked(spark, part):
    docs = edited()
    rows, named = near_copies(frame(spark, docs).select("doc_id", "text"), part)
    got = {r.doc_id: r.component for r in rows.join(named, "row").collect()}
    roots = brute.groups([shingles(t) for _, t in docs], similar)
    pairs = {(got[i], r) for (i, _), r in zip(docs, roots)}
    assert len(pairs) == len({g for g, _ in pairs}) == len(set(roots))
    assert 4 < len(set(roots)) < len({shingles(t) for _, t in docs})


def test_stage_keeps_one_row_of_each_component(spark):
    docs = edited(12) + [(i + 500, t) for i, t in edited(12)[:9]]
    assert stayed(spark, docs) == Counter(wanted(docs))


def test_recall_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets = [shingles(t) for _, t in docs]
    kept = {i for i, _ in stayed(spark, docs)}
    kept_sets = [s for (i, _), s in zip(docs, sets) if i in kept]
    assert not any(similar(a, b) for k, a in enumerate(kept_sets) for b in kept_sets[:k])
    assert kept == {i for i, _ in wanted(docs)}


def test_fingerprints_name_candidates(spark):
    """Without the keys of minima the fingerprint operator alone finds what it can reach,
    and what it puts together is still compared as a whole."""
    docs = edited()
    sets = [shingles(t) for _, t in docs]
    prints = fingerprints_of([t.encode() for _, t in docs], 5).tolist()
    near = brute.groups(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    roots = brute.groups(list(zip(near, sets)), lambda a, b: a[0] == b[0] and similar(a[1], b[1]))
    rows, named = near_copies(frame(spark, docs).select("doc_id", "text"), bands=0)
    got = {r.doc_id: r.component for r in rows.join(named, "row").collect()}
    pairs = {(got[i], r) for (i, _), r in zip(docs, roots)}
    assert len(pairs) == len({g for g, _ in pairs}) == len(set(roots))
    assert len(set(roots)) < len(set(sets))


def test_stage_drops_what_the_operator_links(spark):
    """A text within the radius of another goes even if it shares too few shingles; a text
    without words puts no other out, whatever fingerprint that has."""
    rng = random.Random(40)
    words = [f"w{rng.randint(0, 500)}" for _ in range(60)]
    for _ in range(19):
        edit = list(words)
        edit[rng.randrange(10, 25)], edit[rng.randrange(35, 50)] = "v1", "v2"
    a, b = " ".join(words), " ".join(edit)
    short = "51448 b c d e 51455"
    prints = [int(p) for p in fingerprints_of([t.encode() for t in (a, b, short)], 5)]
    assert (prints[0] ^ prints[1]).bit_count() <= 3 and prints[2].bit_count() <= 3
    assert not similar(shingles(a), shingles(b))
    docs = [(1, ""), (2, a), (3, b), (4, short), (5, None), (6, " ".join(words[:30])), (7, b)]
    assert stayed(spark, docs) == Counter([docs[0], docs[1], docs[3], docs[5]])


def test_threshold_is_inclusive():
    a = np.arange(9, dtype=np.uint64)
    assert similar_forest([a, np.append(a[:8], np.uint64(50))]) == [(0, 1)]  # 8 of 10
    assert similar_forest([a, np.append(a[:7], np.uint64(50))]) == []
    assert [len(s) for s in shingle_sets([b"", b"a B", b"A b", b"a b c d e f"])] == [0, 1, 1, 2]


def test_rows_that_repeat_an_id_or_have_none(spark):
    same = "one text that several rows hold word for word"
    other = "another text that no other row holds at all"
    assert stayed(spark, [(1, same)] * 3 + [(2, same)]) == Counter([(1, same)])
    # an id with two texts, one of them an earlier row's
    assert stayed(spark, [(1, same), (5, same), (5, other)]) == Counter([(1, same), (5, other)])
    assert stayed(spark, [(None, same), (None, same), (3, other), (None, other)]) == Counter(
        [(None, same), (3, other)]
    )
    assert sum(stayed(spark, AWKWARD).values()) == len(wanted(AWKWARD))
