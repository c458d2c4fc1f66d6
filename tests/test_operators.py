from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import dedupe, filters, limits, quality
from shelfmark.operators.phrases import phrase_join, term_hits
from shelfmark.operators.relevance import relevant, score_records
from shelfmark.taxonomy import PHRASE_WEIGHTS


def _python_score(text):
    low = (text or "").lower()
    return sum(w for p, w in PHRASE_WEIGHTS.items() if p in low)


def test_scores(spark):
    texts = [
        "Grounded Theory", "focus group transcript", "memos memos memos memos", "", None,
        "MAXQDA 2022 and NVivo", "reflexive thematic analysis of in-depth interviews",
    ]
    rnd = random.Random(3)
    phrases = list(PHRASE_WEIGHTS)
    texts += [" ".join(rnd.choices([*phrases, "x", "the"], k=12)).upper() for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    out = {r.i: r for r in score_records(df, "text", matched="found").collect()}
    assert [out[i].score for i in range(len(texts))] == [_python_score(t) for t in texts]
    assert out[0].score == 5 and out[1].score == 11 and out[2].score == 3
    assert out[1].found == ["focus group transcript", "focus group", "transcript"]
    kept = {r.i for r in relevant(df, "text").collect()}
    assert kept == {i for i, t in enumerate(texts) if _python_score(t) >= 10}


def _brute(docs, terms):
    return {(i, j) for i, t in docs for j, p in terms if p.strip(" \t\n\r") and p.lower() in (t or "").lower()}


@pytest.mark.parametrize(
    ("seed", "limits_"),
    [(1, {}), (2, {"max_folded": 0}), (3, {"max_broadcast_bytes": 0}), (4, {"max_folded": 0, "max_broadcast_bytes": 0})],
)
def test_phrase_join_matches_brute_force(spark, seed, limits_):
    rnd = random.Random(seed)
    words = ["the", "Then", "other", "a", "an", "x-ray", "Été", "long-word", "théorie", "b"]
    blanks = [" ", "  ", "\n", " "]
    docs = [
        (i, "".join(rnd.choice(words) + rnd.choice(blanks) for _ in range(rnd.randrange(0, 25))))
        for i in range(60)
    ]
    docs += [(60, None), (61, "")]
    terms = []
    for j in range(80):
        text = rnd.choice(docs[:60])[1]
        if text and rnd.random() < 0.7:
            at = rnd.randrange(len(text))
            terms.append((j, text[at : at + rnd.randrange(1, 25)].upper()))
        else:
            terms.append((j, " ".join(rnd.choices(words, k=rnd.randrange(1, 4)))))
    terms += [(80, "missing middle word"), (81, "h"), (82, " ")]
    got = phrase_join(
        spark.createDataFrame(docs, "d int, text string"), "text",
        spark.createDataFrame(terms, "t int, phrase string"), "d", "t", "phrase", **limits_,
    ).collect()
    assert len(got) == len({tuple(r) for r in got})
    # lower-casing in Python and in the JVM agrees on this alphabet
    hits, want = {(r.d, r.t) for r in got}, _brute(docs, terms)
    named = dict(terms)
    assert [(d, named[t]) for d, t in hits ^ want] == []


def test_term_hits(spark):
    docs = [(1, "Open CODING and axial coding"), (2, "nothing"), (3, None)]
    df = spark.createDataFrame(docs, "i int, text string")
    got = {tuple(r) for r in term_hits(df, "text", ["open coding", "Axial Coding"], ["i"]).collect()}
    assert got == {(1, 0, "open coding"), (1, 1, "Axial Coding")}


def _hits(rnd, n):
    return [
        ("s%d" % rnd.randrange(2), "r%d" % rnd.randrange(40), rnd.randrange(4), i // 10, i % 10, rnd.random() < 0.4)
        for i in range(n)
    ]


HITS = "context_repository string, recid string, term_rank int, page int, pos int, ok boolean"


def test_first_accepted_and_first_seen(spark):
    rows = _hits(random.Random(5), 300)
    df = spark.createDataFrame(rows, HITS)
    key = ["context_repository", "recid"]
    accepted, seen = {}, {}
    for row in sorted(rows, key=lambda r: r[2:5]):
        seen.setdefault(row[:2], row)
        if row[5]:
            accepted.setdefault(row[:2], row)
    got = {tuple(r) for r in dedupe.first_accepted(df, key, F.col("ok")).collect()}
    assert got == set(accepted.values())
    got_seen = {tuple(r) for r in dedupe.first_seen(df, key, F.col("ok")).collect()}
    assert got_seen == {r for r in seen.values() if r[5]}
    assert {r[:2] for r in got_seen} <= {r[:2] for r in got}


@pytest.mark.parametrize("n", [1, 3, 7])
def test_cap_per_term_is_the_sequential_walk(spark, n):
    rnd = random.Random(n)
    rows = {(s, r, t): (s, r, t, p, q) for s, r, t, p, q, _ in _hits(rnd, 400)}
    df = spark.createDataFrame(list(rows.values()), HITS.replace(", ok boolean", ""))
    want = set()
    for source in ("s0", "s1"):
        taken = set()
        for term in range(4):
            under = sorted(r for r in rows.values() if r[0] == source and r[2] == term)
            under.sort(key=lambda r: r[3:5])
            fresh = [r for r in under if r[1] not in taken][:n]
            taken |= {r[1] for r in fresh}
            want |= set(fresh)
    assert {tuple(r) for r in limits.cap_per_term(df, n).collect()} == want


@pytest.mark.parametrize("limit", [0, 1000])
def test_cap_per_group_both_ways(spark, monkeypatch, limit):
    """The block-wise way, forced for small numbers, keeps what a plain rank keeps."""
    monkeypatch.setattr(limits, "GROUP_LIMIT", limit)
    rows = [("a" if i % 3 else "b", i % 4, i // 10, i, i) for i in range(200)]
    rows += [(None, None, None, i, 200 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, term_rank int, page int, pos int, i int")
    got = {r.i for r in limits.cap_per_group(df, ["g"], ["term_rank", "page", "pos"], 25).collect()}
    want = set()
    for g in ("a", "b", None):
        mine = [r for r in rows if r[0] == g]
        mine.sort(key=lambda r: tuple((v is not None, v) for v in r[1:4]))
        want |= {r[4] for r in mine[:25]}
    assert got == want


@pytest.mark.parametrize("limit", [0, 1000])
def test_caps_hold_among_ties(spark, monkeypatch, limit):
    """Ten rows to a place, and equal rows: exactly n rows stay, the same on both ways."""
    rows = [(g, i // 10, i % 4) for g in ("a", "b") for i in range(60)] + [("c", 1, 1)] * 30 + [(None, None, None)] * 5
    df = spark.createDataFrame(rows, "g string, place int, v int")
    for n in (1, 9, 13, 25):
        monkeypatch.setattr(limits, "GROUP_LIMIT", 1000)
        plain = sorted(limits.cap_per_group(df, ["g"], ["place"], n).collect(), key=str)
        monkeypatch.setattr(limits, "GROUP_LIMIT", limit)
        got = limits.cap_per_group(df, ["g"], ["place"], n).collect()
        assert sorted(got, key=str) == plain
        for g, size in (("a", 60), ("b", 60), ("c", 30), (None, 5)):
            mine = [r.place for r in got if r.g == g]
            assert len(mine) == min(n, size)
            assert sorted(map(str, mine)) == sorted(str(r[1]) for r in [r for r in rows if r[0] == g][:n])


def test_jobs_do_not_grow_with_terms(spark):
    jobs = []
    for terms in (5, 145):
        rows = [("s", f"r{i % 60}", i % terms, i, 0) for i in range(300)]
        df = spark.createDataFrame(rows, HITS.replace(", ok boolean", ""))
        spark.sparkContext.setJobGroup(f"terms-{terms}", "")
        limits.cap_per_term(df, 2).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"terms-{terms}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] > 0 and jobs[1] <= jobs[0] + 1


def test_fresh_file_urls(spark):
    rows = [
        ("r1", 0, [("u1",), ("u1",), ("u2",)]),
        ("r2", 1, [("u2",)]),
        ("r3", 2, [("u2",), ("u3",)]),
    ]
    df = spark.createDataFrame(rows, "recid string, pos int, files array<struct<file_url string>>")
    got = {r.recid: [f.file_url for f in r.files] for r in dedupe.fresh_file_urls(df, ["recid"], ["pos"]).collect()}
    # repeated within its first record stays; a record left empty disappears
    assert got == {"r1": ["u1", "u1", "u2"], "r3": ["u3"]}


def test_best_versions(spark):
    rows = [(1, "t", None, "cessda"), (2, "t", "10.1", "cessda"), (3, "t", "10.1", "qdr"), (4, "u", None, "x")]
    df = spark.createDataFrame(rows, "id int, title string, doi string, repo string")
    prefer = [
        ("no_doi", F.col("doi").isNull().cast("int")),
        ("mirror", F.col("repo").isin("cessda").cast("int")),
    ]
    got = {tuple(r) for r in dedupe.best_versions(df, ["title"], "id", prefer).collect()}
    assert got == {("t", 3, 3), ("u", 4, 1)}


def test_file_filters(spark):
    files = "array<struct<file_key string, file_url string, restricted boolean>>"
    df = spark.createDataFrame(
        [(1, [("a.qdpx", "u", None), ("b.pdf", "u", False)]), (2, [("c.pdf", "u", True)]), (3, [])],
        f"i int, files {files}",
    )
    assert [r.i for r in filters.with_files(df).orderBy("i").collect()] == [1, 2]
    strict = filters.strict_records(df).collect()
    assert [(r.i, [f.file_key for f in r.files]) for r in strict] == [(1, ["a.qdpx"])]
    rows = df.select("i", F.inline("files"))
    accessible, restricted = filters.split_restricted(rows)
    assert (accessible.count(), restricted.count()) == (2, 1)
    usable = df.select(F.explode(filters.usable_files(F.col("files"))).alias("f")).count()
    assert usable == 3


def test_language_and_description(spark):
    rows = [
        (1, "Der Hund und die Katze, nicht der Vogel", None, "t", ["k"]),
        (2, "the end of the story", " ", "t", ["k"]),
        (3, "le chat et les chiens", "xx", "t", ["k"]),
        (4, "zzz", None, "t", ["k"]),
        (5, " ", None, None, ["k", "l"]),
    ]
    df = spark.createDataFrame(rows, "i int, description string, language string, title string, keywords array<string>")
    filled = {r.i: r.language for r in quality.fill_language(df).collect()}
    assert filled == {1: "de", 2: "en", 3: "xx", 4: None, 5: None}
    texts = {r.i: r.description for r in quality.fill_description(df, keywords="keywords").collect()}
    assert texts[5] == "k, l" and texts[4] == "zzz"


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("", 3)], "s string, n int")
    got = {r.column_name: tuple(r)[2:] for r in quality.profile(df, "x", long_text=["s"], exact=True).collect()}
    assert got == {"s": (3, 0, 1, 2, 1), "n": (3, 1, 0, 2, 0)}
    assert quality.profile(df, "x").count() == 2


@pytest.mark.parametrize("few", [0, 3, 10_000])
def test_short_terms_by_vocabulary(spark, monkeypatch, few):
    """Letters, pieces of words and pairs of words, whichever of them are folded; no
    join builds a hash table over exploded rows."""
    from shelfmark.operators import phrases

    monkeypatch.setattr(phrases, "FEW_WORDS", few)
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdé", k=rnd.randint(1, 7))) for _ in range(40)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 20))) for _ in range(80)] + [None, ""]
    terms = list("abcdéz") + rnd.choices(words, k=15)
    terms += [f"{rnd.choice(words)} {rnd.choice(words)}" for _ in range(60)]
    terms += [f"{w[-2:]} {v[:2]}" for w, v in zip(words, words[1:])] + ["  ", " a "]
    got = phrase_join(
        spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)], "d int, text string"),
        "text", spark.createDataFrame(list(enumerate(terms)), "t int, phrase string"),
        "d", "t", "phrase", max_folded=0,
    )
    want = {
        (i % 50, j) for i, t in enumerate(texts) for j, p in enumerate(terms)
        if t and p.strip() and p.lower() in t.lower()
    }
    assert {tuple(r) for r in got.collect()} == want
    plan = got._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" not in plan


@pytest.mark.parametrize(("few_phrases", "max_bytes"), [(2048, 64 << 20), (5, 64 << 20), (5, 0)])
def test_words_that_hold_a_term_are_few(spark, monkeypatch, few_phrases, max_bytes):
    """However many pieces are held by many words, texts meet phrases at no more than
    ``FEW_WORDS`` words of each piece; the other phrases are searched in the texts."""
    from shelfmark.operators import phrases

    monkeypatch.setattr(phrases, "FEW_WORDS", 3)
    monkeypatch.setattr(phrases, "MAX_FREQUENT_PHRASES", few_phrases, raising=False)
    joined = []
    for name in ("_met_by_broadcast", "_met_by_merge"):
        plain = getattr(phrases, name)
        monkeypatch.setattr(
            phrases, name, lambda docs, anchored, plain=plain: joined.append(anchored) or plain(docs, anchored)
        )
    pieces = [a + b for a in "abcdefghij" for b in "klmnopqrsé"]
    words = [f"{x}{p}{y}" for p in pieces for x in "xy" for y in ("u", "", "vé")]
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(50)] + [" ".join(words), "rare one", None]
    terms = [*pieces, *(f"{v} y{p}" for v, p in zip(words, pieces)), "rare", "re on", "none"]
    got = phrase_join(
        spark.createDataFrame(list(enumerate(texts)), "d int, text string"), "text",
        spark.createDataFrame(list(enumerate(terms)), "t int, phrase string"),
        "d", "t", "phrase", max_folded=0, max_broadcast_bytes=max_bytes,
    )
    want = {(i, j) for i, t in enumerate(texts) for j, p in enumerate(terms) if t and p in t}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert len(joined) == 1
    counts = {r["phrase"]: r["count"] for r in joined[0].groupBy("phrase").count().collect()}
    assert {"rare", "re on"} <= set(counts) and max(counts.values()) <= 3


def test_pieces_are_looked_up_in_words():
    from shelfmark.operators.phrases import _lookup

    rnd = random.Random(9)
    words = ["".join(rnd.choices("abé学", k=rnd.randint(1, 9))) for _ in range(300)]
    pieces = sorted({*"abcé学", *("".join(rnd.choices("abé学", k=rnd.randint(1, 6))) for _ in range(200))})
    got = [(i, held.tolist()) for i, held in _lookup(pieces)([w.encode() for w in words])]
    want = {i: held for i, p in enumerate(pieces) if (held := [k for k, w in enumerate(words) if p in w])}
    assert len(got) == len(want) and dict(got) == want
    assert not list(_lookup([])([b"a"])) and not list(_lookup(["a"])([]))


def test_folded_terms_share_records(spark):
    """More phrases than one number has bits, over texts of one id; what moves is a row of
    bits per record and no (record, term) pair."""
    from shelfmark.operators.phrases import _folded, _search

    words = [f"w{i}x" for i in range(150)]
    terms = [*words, "w1x w2x", " w3x"]
    texts = [(i % 20, " ".join(words[i % 150 : i % 150 + 3]) + " ") for i in range(60)]
    docs = spark.createDataFrame(texts, "record_id int, _lowered string")
    got = _folded(docs, [(t, [i, i + 1000]) for i, t in enumerate(terms)], "int")
    want = {(d, k) for d, x in texts for i, t in enumerate(terms) if t in x for k in (i, i + 1000)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert _search(["a", "b c", "c", "the "])(b"xa b the c") == 0b1101


def test_hits_out_of_reach_do_not_move(spark):
    """Hits beyond the bound of a slice are left out, and never one that is taken."""
    rnd = random.Random(5)
    rows = [
        (rnd.choice("ab"), rnd.randrange(300), rnd.choice([0, 1, 2]), rnd.choice([None, *range(40)]), i)
        for i in range(1500)
    ]
    hits = spark.createDataFrame(rows, "context_repository string, recid int, term_rank int, page int, pos int")
    placed = hits.withColumn("_at", F.col("term_rank"))
    order = ("page", "pos")
    near = limits._within_reach(placed, 4, "context_repository", "recid", order, slices=4)
    left = {tuple(r)[:5] for r in near.collect()}
    assert len(left) < len(rows)
    want, first = set(), lambda r: (r[3] is not None, r[3] or 0, r[4])
    for source in "ab":
        taken = set()
        for rank in (0, 1, 2):
            own = sorted((r for r in rows if r[0] == source and r[2] == rank), key=first)
            fresh = [r for r in own if r[1] not in taken][:4]
            taken |= {r[1] for r in fresh}
            want |= set(fresh)
    assert want <= left
    assert {tuple(r) for r in limits.cap_per_term(hits, 4).collect()} == want
