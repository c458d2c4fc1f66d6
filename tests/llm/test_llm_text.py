"""Decontamination, licenses, sharding, packing, fingerprints, chat and toxicity."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from brute import AWKWARD, LOWER, SF, crc, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import chat, decontaminate, packing, queries, toxicity
from shelfmark.llm.fingerprints import (
    edited_fingerprints,
    edited_text,
    fingerprints,
    with_neighbours,
    within,
)
from shelfmark.llm.folding import fold
from shelfmark.llm.license_rules import BASE, rules
from shelfmark.llm.licenses import scan_licenses
from shelfmark.llm.sharding import deal, range_number, shard


def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# decontamination

def folded(text):
    return "".join(map(chr, fold(text)[0]))


def test_items_are_found_within_their_budget():
    rng = random.Random(2)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    items = [(i, " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 8))) for _ in range(n)))
             for i, n in enumerate((4, 8, 15, 30, 60))]
    index = decontaminate.build_index(items)
    for item, text in items:
        budget = decontaminate.edit_budget(len(text), 8, decontaminate.RATE)
        for edits in (0, budget // 2, budget):
            for _ in range(8):
                changed = list(text)
                for _ in range(edits):
                    at = rng.choice([k for k, c in enumerate(changed) if c != " "])
                    kind = rng.random()
                    if kind < 0.4:
                        changed[at] = rng.choice(alphabet)
                    elif kind < 0.7:
                        changed.insert(at, rng.choice(alphabet))
                    elif changed[at - 1 : at] != [" "] and changed[at + 1 : at + 2] != [" "] and 0 < at < len(changed) - 1:
                        del changed[at]
                before = " ".join("".join(rng.choices(alphabet, k=5)) for _ in range(40))
                doc = before.upper() + ".\n" + "".join(changed) + "!  " + before
                true = brute.edit_distance_inside(text, folded(doc))
                found = {index.ids[i][0]: (a, b, e) for _, i, a, b, e in decontaminate.find_items([doc], index)}
                assert true <= edits and found[item][2] == true
                assert abs(found[item][0] - len(before) - 2) <= edits


def test_clean_documents_hold_nothing():
    rng = random.Random(4)
    items = [(1, " ".join(f"w{rng.randint(0, 99)}" for _ in range(30)))]
    index = decontaminate.build_index(items)
    for _ in range(30):
        doc = " ".join(f"w{rng.randint(0, 99)}" for _ in range(300))
        found = decontaminate.find_items([doc, "", items[0][1][:60]], index)
        limit = decontaminate.edit_budget(len(items[0][1]), 8, decontaminate.RATE)
        assert bool(found) == (brute.edit_distance_inside(items[0][1], folded(doc)) <= limit)


def test_slices_and_neighbours(monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 500)
    item = "the quick brown fox jumps over the lazy dog and runs away from it at once"
    index = decontaminate.build_index([(1, item), (2, item.upper()), (3, "short"), (4, None)])
    pad = "zz yy xx ww " * 60
    for at in range(0, 700, 35):
        doc = pad[:at] + " " + item + " " + pad
        assert [(t, e) for t, i, _, _, e in decontaminate.find_items(["a", doc, "b"], index)] == [(1, 0)]
    # half an item at the end of one text, half at the start of the next
    assert decontaminate.find_items([pad + item[:40], item[40:] + pad], index) == []
    assert sorted(index.ids[0]) == [1, 2]


def test_leaks_as_tables(spark):
    item = "Benchmark item: what is the boiling point of water at sea level, in kelvin?"
    docs = [*AWKWARD, (20, f"intro\n{item} outro"), (21, "x" + item.lower().replace(",", ";").replace("boil", "bol")), (22, item[:30])]
    bench = spark.createDataFrame([(5, item), (6, None), (7, ""), (8, item), (9, "tiny")], "item_id long, text string")
    want = [(20, 5, 0), (20, 8, 0), (21, 5, 1), (21, 8, 1)]
    for block in (4_000_000, 50):
        got = decontaminate.leaked_items(frame(spark, docs), bench, block_chars=block)
        assert sorted((r.doc_id, r.item_id, r.edits) for r in got.collect()) == want
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaked_items(frame(spark, docs), none).count() == 0
    assert decontaminate.leaked_items(frame(spark, []), bench).count() == 0


def test_leak_query_finds_folded_passages(spark):
    items = {r.item_id: folded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {i: folded(t) for i, t in documents(spark).items()}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_decontaminate"](spark, SF).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got
    for d, i in got:
        limit = decontaminate.edit_budget(len(items[i]), 8, decontaminate.RATE)
        assert brute.edit_distance_inside(items[i], docs[d]) <= limit


# licenses

def scanned(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    line = " " + " ".join(w) + " "
    found = [
        (m.start(), m.end(), r) for r in rules() for m in re.finditer(r.pattern, line)
        if f"{r.keyword}" in line
    ]
    kept = [
        a for a in found
        if not any(
            b[0] <= a[0] and b[1] >= a[1] and b[2].rank <= a[2].rank
            and ((b[1] - b[0]) > (a[1] - a[0]) or (b[2].rank, b[2].id) < (a[2].rank, a[2].id))
            for b in found
        )
    ]
    return (
        len(w), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {k[2].label for k in kept})),
        max((k[2].score for k in kept), default=0.0),
    )


LICENSED = [
    (30, "Licensed under the GNU General Public License version 3 or later; all rights reserved."),
    (31, "SPDX-License-Identifier: Apache-2.0\nCopyright (c) 2020 x. CC BY-NC-SA 4.0, CC-BY-NC, cc by nc"),
    (32, "under the mit license under the mit license under the mit licence UNDER THE MIT LICENSE"),
    (33, "This work is released under a Creative Commons Attribution-ShareAlike 4.0 license"),
    (34, "submit license; admit; xcc by nc; cc by ncx; apache license version 20"),
    (35, "Redistribution and use in source and binary forms, with or without modification, BSD 3-Clause"),
    (36, "İn the MİT license K kelvin; dedicated to the public domain"),
]


def test_licenses(spark):
    assert len(rules()) > 300
    docs = AWKWARD + LICENSED
    got = scan_licenses(frame(spark, docs))
    want = sorted(((i, *scanned(t)) for i, t in docs), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert scan_licenses(frame(spark, [])).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_license_query(spark):
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op5_license_scan"](spark, SF).collect()}
    assert got == {i: scanned(t) for i, t in documents(spark).items()}


# sharding

def check_shards(rows, texts, shards=16):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((t or "").encode()) + 1, crc(t)) for _, t in texts
    )
    slots, filled = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        filled[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards)) and {r.law for r in rows} <= {"bytes"}
    assert all(r.grown_shard is None for r in rows)
    return filled


def test_shards_of_documents(spark):
    docs = documents(spark)
    df = queries.QUERIES["op6_sharding"](spark, SF)
    rows = df.collect()
    filled = check_shards(rows, docs.items())
    mean = sum(filled.values()) / 16
    assert max(filled.values()) <= max(1.02 * mean, max(len(t.encode()) + 1 for t in docs.values()))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())


def test_shards_with_one_text_in_a_third_of_all_rows(spark):
    docs = [(i, "hot text of some length" if i % 3 == 0 else f"text {i} " * (i % 7)) for i in range(3000)]
    filled = check_shards(shard(frame(spark, docs, ())).collect(), docs)
    assert max(filled.values()) < 1.05 * min(filled.values())


def test_equal_texts_stay_together(spark):
    docs = [(i, f"group {i % 200} " * 5) for i in range(2000)]
    at = defaultdict(set)
    rows = shard(frame(spark, docs, ())).collect()
    for r in rows:
        at[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in at.values())
    check_shards(rows, docs)


def test_shards_awkward(spark):
    check_shards(shard(frame(spark, AWKWARD)).collect(), AWKWARD)
    assert shard(frame(spark, [])).count() == 0


def test_range_numbers(spark):
    bounds = sorted(random.Random(0).sample(range(-500, 500), 100))
    df = spark.range(-600, 600).select("id", range_number(F.col("id"), bounds).alias("r"))
    assert all(r.r == sum(b <= r.id for b in bounds) for r in df.collect())
    assert deal([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_short_items_are_found(spark):
    """Items without a q-gram are found word by word; longer ones beside them as before."""
    bench = spark.createDataFrame(
        [(1, "cat"), (2, "A b"), (3, "...") , (4, "x" * 30), (5, None), (6, "Été"), (7, "CAT!")], "item_id long, text string"
    )
    docs = [
        (1, "the cat, sat"), (2, "concatenate a bc"), (3, "cat"), (4, "so: a (b) c " + "x" * 30), (5, None), (6, "l'été, CAT"),
    ]
    got = decontaminate.leaked_items(frame(spark, docs), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (1, 7), (3, 1), (3, 7), (4, 2), (4, 4), (6, 1), (6, 6), (6, 7)]
    texts = dict(docs)
    assert {texts[r.doc_id][r.start : r.end] for r in got} == {"cat", "a (b", "x" * 30, "été", "CAT"}


def test_frequent_grams_in_runs(monkeypatch):
    """Bands are the same whether their grams are expanded in one run or in many."""
    rng = random.Random(4)
    words = ["common", "words", "again", "and"]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(30)]
    index = decontaminate.build_index(items)
    text = " ".join(rng.choices(words, k=300)) + " " + items[3][1]
    whole = decontaminate.find_items([text], index)
    monkeypatch.setattr(decontaminate, "_RUN", 500)
    assert decontaminate.find_items([text], index) == whole and any(i == 3 for _, i, *_ in whole)


# packing

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers as public

    added = packing.added_tokens(public.path("byte_bpe_50k.json"))
    return packing.Tokens(public.path("byte_bpe_50k.tiktoken"), public.PATTERN, memo=50, added=added)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab .,'s1é漢\n\t\r\x1c\x85\xa0 　"), max_size=30))
def test_ids_are_those_of_the_tokenizer(tokenizer, tokens, text):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.ids(text), "<u4").tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "a", "\n", "x.", "<|"]), max_size=8))
def test_added_tokens_keep_their_ids(tokenizer, tokens, parts):
    text = "".join(parts)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.ids(text), "<u4").tolist() == want


def check_packed(rows, docs, tokenizer, fill=0.0):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in docs.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    if by_sequence:
        assert sum(r.length for r in rows) >= fill * 2048 * len(by_sequence)


def test_packing_query(spark, tokenizer):
    check_packed(queries.QUERIES["op7_packing"](spark, SF).collect(), documents(spark), tokenizer, 0.95)


def test_packing_awkward(spark, tokenizer):
    docs = {i: t for i, t in AWKWARD if i not in (None, 11)}
    docs[30] = "a <|endoftext|> b<|endoftext|><|endoftext|>"
    rows = packing.pack(frame(spark, AWKWARD)).collect()
    check_packed(rows, {}, tokenizer)
    ids = {(r.doc_id, r.start) for r in rows}
    assert (None, 0) in ids and (3, 0) in ids
    check_packed(packing.pack(frame(spark, list(docs.items()))).collect(), docs, tokenizer)
    assert packing.pack(frame(spark, [])).count() == 0


def test_differencing():
    rng = random.Random(0)
    for n in (1, 2, 7, 60):
        sizes = [rng.randint(1, 512) for _ in range(n)]
        for count in (1, 3, 10):
            dealt = packing.differencing(sizes, count)
            assert sorted(i for w in dealt for i in w) == list(range(n)) and len(dealt) == count
        assert all(sum(sizes[i] for i in w) <= 512 for w in packing.windows_of(sizes, 512))
    # the classic example: 8 7 6 5 4 in two windows ends with a difference of 2
    dealt = packing.differencing([8, 7, 6, 5, 4], 2)
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in dealt)
    assert sums == [14, 16]
    # three near-full items need a window each, though two could hold the sum
    assert len(packing.windows_of([300, 300, 300], 512)) == 3
    assert packing.cuts(2048 * 2 + 1000, 2048, 512) == [(0, 2048), (2048, 2048), (4096, 500), (4596, 500)]


# fingerprints

def check_edited(rows, docs):
    """``docs`` in descending order."""
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    bits = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count() / 128
    for k, (i, t) in enumerate(docs):
        t, (j, n) = t or "", docs[(k + 1) % len(docs)]
        r = by_id[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == brute.sha(edited_text(t, n or ""))
        assert r.near_next == pytest.approx(1 - bits(r.fingerprint, by_id[j].fingerprint))
        assert r.near_edited == pytest.approx(1 - bits(r.fingerprint, r.edited_fingerprint))


def test_edited_query(spark):
    docs = sorted(documents(spark).items(), reverse=True)
    rows = queries.QUERIES["op8_fingerprints"](spark, SF).collect()
    check_edited(rows, docs)
    prints = defaultdict(set)
    for r in rows:
        prints[dict(docs)[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)
    check_neighbours(rows)


def check_neighbours(rows):
    values = [int(r.fingerprint, 16) for r in rows]
    for r, v in zip(rows, values):
        near = sum((v ^ w).bit_count() <= 6 for w in values)
        assert r.n_within == (near if r.doc_id is not None and r.doc_id % 50 == 0 else None)


def test_neighbours_of_awkward_rows(spark):
    docs = [*AWKWARD, (None, "none"), (100, "a b c"), (100, "a b c"), (150, None), (151, "A b c"), (50, "a b c")]
    rows = with_neighbours(fingerprints(frame(spark, docs)), F.col("doc_id") % 50 == 0).collect()
    assert len(rows) == len(docs)
    check_neighbours(rows)
    assert with_neighbours(fingerprints(frame(spark, [])), F.col("doc_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("radius", [1, 3, 5])
def test_blocks_over_the_ends_of_lanes(spark, radius):
    """128 bits in 3, 5 and 7 blocks, some of them in two lanes."""
    rng = random.Random(radius)
    values = []
    for _ in range(30):
        v = rng.getrandbits(128)
        values += [v] + [v ^ (1 << rng.randrange(50, 80)) ^ (1 << rng.randrange(128)) for _ in range(5)]
    df = spark.createDataFrame([(f"{v:032x}",) for v in values], "fingerprint string")
    got = [(r["query"], r.fingerprint, r.distance) for r in within(df, df, radius).collect()]
    want = {(f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in values for b in values if (a ^ b).bit_count() <= radius}
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("ranges", [2, 5, 1024])
def test_edited_awkward(spark, ranges):
    docs = [d for d in AWKWARD if d[0] != 11]
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    check_edited(edited_fingerprints(frame(spark, docs), ranges).collect(), order)


def test_edited_of_few_rows(spark):
    assert edited_fingerprints(frame(spark, [])).count() == 0
    one = edited_fingerprints(frame(spark, [(4, "abcd")])).first()
    assert one.edited_sha256 == brute.sha("abab") and one.near_next == 1.0
    again = edited_fingerprints(frame(spark, [(4, "abcd"), (4, "abcd"), (3, None)]), 3).collect()
    assert len(again) == 3


def test_within_radius_against_brute_force(spark):
    rng = random.Random(8)
    values = []
    for _ in range(20):
        center = rng.getrandbits(128)
        for _ in range(6):
            v = center
            for _ in range(rng.randint(0, 9)):
                v ^= 1 << rng.randrange(128)
            values += [f"{v:032x}"] * rng.randint(1, 3)
    df = spark.createDataFrame([(v,) for v in values], "fingerprint string")
    asked = df.limit(40)
    chosen = {r.fingerprint for r in asked.collect()}
    counts = Counter(values)
    want = {
        (q, v, (int(q, 16) ^ int(v, 16)).bit_count(), n)
        for q in chosen for v, n in counts.items() if (int(q, 16) ^ int(v, 16)).bit_count() <= 6
    }
    got = within(df, spark.createDataFrame([(q,) for q in chosen], "fingerprint string"), 6)
    assert {(r["query"], r.fingerprint, r.distance, r.rows) for r in got.collect()} == want


def test_fingerprints_follow_likeness(spark):
    a = " ".join(f"w{i}" for i in range(300))
    b = a.replace("w7 ", "v7 ")
    got = {r.doc_id: int(r.fingerprint, 16) for r in fingerprints(frame(spark, [(1, a), (2, b), (3, a[::-1]), (4, a)])).collect()}
    assert got[1] == got[4]
    assert (got[1] ^ got[2]).bit_count() < 15 < (got[1] ^ got[3]).bit_count()


# chat

@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "a\nb", "<|im_end|>", "x\\n"]),
    st.text(st.sampled_from("<|\\im_endstar>\n ab"), max_size=25))))
def test_template_round_trip(turns):
    text, spans = chat.format_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_chat_query(spark):
    talks = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        talks[r.conv_id].append((r.role, r.text or ""))
    control = "<|im_end|><|im_start|>assistant ok"
    talks[-1] = [("user", control), ("assistant", control)]
    got = {tuple(r)[:5] for r in queries.QUERIES["op9_chat_format"](spark, SF).collect()}
    want = set()
    for i, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        want.add((i, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest()))
    assert got == want


def test_reply_trees(spark):
    #      1 - 2 - 4        tree 9 is a circle with a tail, tree 3 a single message
    #        \ 3 - 5 - 6    whose parent is missing
    rows = [(7, 1, None, 0.0), (7, 2, 1, 1.0), (7, 3, 1, 5.0), (7, 4, 2, 1.0), (7, 5, 3, 5.0), (7, 6, 5, 5.0),
            (9, 1, 2, 1.0), (9, 2, 1, 1.0), (9, 3, 2, 1.0), (3, 1, 44, None), (None, 1, None, 2.0)]
    df = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, score double")
    paths = defaultdict(list)
    for r in chat.reply_paths(df, best=None).orderBy("depth").collect():
        paths[r.tree_id, r.leaf_id, r["rank"]].append(r.node_id)
    assert paths == {(7, 6, 1): [1, 3, 5, 6], (7, 4, 2): [1, 2, 4], (3, 1, 1): [1], (None, 1, 1): [1]}
    assert {r.leaf_id for r in chat.reply_paths(df).where("tree_id = 7").collect()} == {6}


def test_conversations_awkward(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, ""), (1, 2, "assistant", None), (None, 0, "user", "x"),
            (None, None, "assistant", "y"), (2, 5, "assistant", "z" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS depth", "'q' AS turns", "2 AS node_id", "3 AS leaf_id")
    got = {r.conv_id: r for r in chat.read_back(chat.format_trees(chat.chained(df))).collect()}
    assert {i: (r.n_turns, r.loss_chars) for i, r in got.items()} == {1: (3, 0), None: (2, 1), 2: (1, 50_000)}
    assert chat.read_back(chat.format_trees(chat.chained(df.limit(0)))).count() == 0


def test_a_long_chain(spark):
    df = spark.range(300).selectExpr("1L AS conv_id", "id AS turn", "'user' AS role", "string(id) AS text")
    row = chat.format_trees(chat.chained(df)).first()
    assert [t for _, t in chat.read_turns(row.formatted)] == [str(i) for i in range(300)]


# toxicity

def test_toxicity_on_unseen_words(spark):
    rng = random.Random(3)
    syllables = "ka lo mi ne su ta ri po ve da".split()
    bad = ["zorgle", "quvax"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(900):
        text = [word() for _ in range(rng.randint(10, 120))]
        toxic = int(rng.random() < 0.4)
        if toxic:
            for _ in range(1 + len(text) // 30):
                # a new ending each time: only the n-grams are known
                text.insert(rng.randrange(len(text)), rng.choice(bad) + word())
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    df = frame(spark, docs, ())
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, marks)
    kept = toxicity.score(df, model, carry=["text", "source"])
    truth = {i: y for i, _, y in labels}
    tested = [r for r in kept.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum(r.predicted == truth[r.doc_id] for r in tested)
    assert right >= 0.93 * len(tested) and all(0 <= r.score <= 1 for r in tested)
    assert {r.source for r in tested} == {"src"}
    # labels of the held-out rows change nothing
    turned = marks.selectExpr(
        "doc_id", "quality", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - toxic, toxic) AS toxic"
    )
    assert np.array_equal(toxicity.train(df, turned).table, model.table)
    # texts in any company score the same
    texts = [t for _, t in docs[:50]] + ["", "...", "a"]
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts])


def test_toxicity_awkward(spark):
    marks = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, None, None), (None, 1, 1), (4, 0, 0), (8, 1, 0), (77, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    df = frame(spark, AWKWARD)
    model = toxicity.train(df, marks)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(blank) == 1
    nothing = toxicity.train(df, marks.limit(0))
    assert nothing is None and {r.score for r in toxicity.score(df, nothing).collect()} == {0.0}
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_toxicity_query(spark):
    rows = queries.QUERIES["op10_toxicity"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert {r.predicted == int(r.score >= 0.7) for r in rows} == {True}
