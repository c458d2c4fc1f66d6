"""Line, substring and near-duplicate operators against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import oracle
import pytest
from brute import AWKWARD, SF, frame

from shelfmark.llm import queries
from shelfmark.llm.arrays import bit_counts, leftmost_minimum, run_hashes
from shelfmark.llm.components import components
from shelfmark.llm.line_dedup import drop_shared_lines
from shelfmark.llm.simhash_dups import fingerprint_links, link_forest, near_duplicates
from shelfmark.llm.substring_dedup import drop_repeated_passages


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_against_sql(spark, name):
    con = oracle.connect(SF)
    df = queries.QUERIES[name](spark, SF)
    mine = oracle._sorted(df.columns, [tuple(r) for r in df.collect()])
    theirs = con.execute(queries.ORACLE[name])
    assert mine == oracle._sorted([d[0] for d in theirs.description], theirs.fetchall())


def test_lines_awkward(spark):
    got = rows(drop_shared_lines(frame(spark, AWKWARD)), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == sorted(brute.line_dedup(AWKWARD), key=str)


@pytest.mark.parametrize("bits", [19, 20])
def test_lines_when_the_filter_is_full(spark, bits):
    rng = random.Random(1)
    lines = [f"line number {i} of many" for i in range(400)]
    docs = [(i, "\n".join(rng.choices(lines, k=12))) for i in range(200)]
    got = drop_shared_lines(frame(spark, docs, ()).repartition(7), bits=bits)
    assert rows(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(
        brute.line_dedup(docs), key=str
    )


def test_lines_carry_columns(spark):
    got = drop_shared_lines(frame(spark, AWKWARD), carry=["lang", "source"])
    assert {r.source for r in got.collect()} == {"src"}


def test_lines_of_no_rows(spark):
    assert drop_shared_lines(frame(spark, [])).count() == 0


def passages(seed, n, vocabulary):
    rng = random.Random(seed)
    shared = [[rng.choice(vocabulary) for _ in range(k)] for k in (20, 21, 24, 40, 75)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 5)):
            text += [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
            part = rng.choice(shared)
            cut = rng.randint(0, 3)
            text += part[cut:] if rng.random() < 0.5 else part
        docs.append((i * 3, " ".join(text)))
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_passages_against_brute_force(spark, seed):
    # few words: many equal windows, also inside one document
    docs = passages(seed, 60, ["a", "b", "c"] if seed == 0 else [f"w{i}" for i in range(40 + seed)])
    got = drop_repeated_passages(frame(spark, docs, ()).repartition(5))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        brute.substring_dedup(docs), key=str
    )


def test_periodic_text(spark):
    docs = [(1, "x " * 70), (2, "y x " * 40), (3, "x " * 19), (4, "x " * 20)]
    got = drop_repeated_passages(frame(spark, docs))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        brute.substring_dedup(docs), key=str
    )


def test_passages_awkward(spark):
    got = drop_repeated_passages(frame(spark, AWKWARD), carry=["source"])
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        brute.substring_dedup(AWKWARD), key=str
    )
    assert drop_repeated_passages(frame(spark, [])).count() == 0


def test_rows_that_share_an_id_but_not_the_text(spark):
    a = " ".join(f"a{i}" for i in range(30))
    b = " ".join(f"b{i}" for i in range(30))
    got = drop_repeated_passages(frame(spark, [(1, a), (2, b), (2, a)]))
    assert sorted(r.n_removed for r in got.collect()) == [0, 0, 30]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(n)] for n in (400, 900, 1500, 2500)]
    docs = []
    for i in range(80):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = f"v{rng.randint(0, 9)}"
        docs.append((i + 10, " ".join(text)))
    docs += [(1, None), (2, ""), (3, "one"), (4, "ONE"), (5, "one two")]
    got = rows(near_duplicates(frame(spark, docs)), "doc_id", "fingerprint", "component_id")
    want = sorted(brute.simhash_dups(docs), key=str)
    assert got == want
    assert 3 < len({r[2] for r in want}) < len({r[1] for r in want})


def test_near_duplicate_queries(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries.QUERIES["op4_simhash_dups"](spark, SF), "doc_id", "fingerprint", "component_id")
    assert got == sorted(brute.simhash_dups(docs), key=str)


@pytest.mark.parametrize("group", [50_000, 7])
def test_links_connect_what_is_near(spark, group):
    rng = np.random.default_rng(3)
    values = set()
    for center in rng.integers(0, 2**63, 12).tolist():
        for _ in range(30):
            v = center
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                v ^= 1 << bit
            values.add(v)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    links = fingerprint_links(df, 3, group)
    found = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in links.collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in map(tuple, found))
    want = brute.groups(values, lambda a, b: (a ^ b).bit_count() <= 3)
    got = brute.groups(values, lambda a, b: frozenset((a, b)) in found)
    assert got == want


def test_forest_is_no_all_pairs():
    values = np.arange(8, dtype=np.uint64)  # all within three bits
    assert len(link_forest(values, 3)) == 7


def test_near_duplicates_awkward(spark):
    got = near_duplicates(frame(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}
    assert {r.component_id for r in got if r.doc_id in (11, 12)} == {11}
    assert near_duplicates(frame(spark, [])).count() == 0


def test_components_of_a_chain_a_star_and_a_circle(spark):
    links = [(i, i + 1) for i in range(100, 164)]
    links += [(500, i) for i in range(501, 560)] + [(900, 901), (901, 902), (902, 900), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(100, 165)} == {100}
    assert {got[i] for i in range(500, 560)} == {500}
    assert {got[i] for i in (900, 901, 902)} == {900} and 7 not in got


def test_array_helpers():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 700, dtype=np.uint64)
    edges = np.array([0, 1, 300, 700])
    counts = bit_counts(h, edges)
    for i in range(3):
        part = h[edges[i] : edges[i + 1]]
        assert counts[i].tolist() == [int(((part >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
    v = rng.integers(0, 4, 60)
    assert [int(x) for x in leftmost_minimum(v, 9)] == [i + int(np.argmin(v[i : i + 9])) for i in range(52)]
    assert len(run_hashes(h, 20)) == 681 and len(run_hashes(h[:5], 6)) == 0


def test_plans_hold_no_cross_join(spark):
    df = drop_shared_lines(frame(spark, AWKWARD))
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
