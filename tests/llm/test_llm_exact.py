"""Exact dedup by keyed state: batches, collisions, awkward rows."""

from __future__ import annotations

import random

import brute
import pytest
from brute import AWKWARD, frame

from shelfmark.llm.exact_dedup import decisions, ingest, keyed_state, landed
from shelfmark.session import shared_folder

CLASHES = ("digest", "file", "row", "sha", "body", "keeper", "met", "best", "_metadata", "_probe", "_page")


def write(spark, folder, rows, files=1):
    frame(spark, rows, CLASHES).repartition(files).write.mode("append").parquet(folder)


def check(got, rows):
    got = got.collect()
    mine = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str)
    assert mine == sorted(brute.exact_dedup(rows), key=str)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


BLANKS = [(20, "a b\tc"), (21, "ab c"), (19, "abc"), (22, "a bc"), (23, "A b c"), (None, "a b  c   ")]


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_awkward_rows(spark, digest_bytes):
    """With digests of one byte most groups hold several texts, and all come apart."""
    folder, store = shared_folder(spark, "landed"), shared_folder(spark, "exact")
    rng = random.Random(3)
    many = [(100 + i, " " * rng.randint(0, 3) + f"text {rng.randint(0, 300)}") for i in range(900)]
    rows = AWKWARD + BLANKS + many
    write(spark, folder, rows, files=3)
    documents = spark.read.parquet(folder)
    ingest(landed(spark, folder, documents.schema), store, digest_bytes)
    check(decisions(documents, store, digest_bytes, bits=16), rows)


def test_state_goes_on(spark):
    """One file per batch, then more files: the state is carried on, and a longer copy
    that lands later takes the place of the one that stayed."""
    folder, store = shared_folder(spark, "landed"), shared_folder(spark, "exact")
    first = [(i, f"text {i % 7}") for i in range(1, 60)]
    write(spark, folder, first, files=4)
    schema = spark.read.parquet(folder).schema
    ingest(landed(spark, folder, schema, batch_bytes=1), store)
    check(decisions(spark.read.parquet(folder), store), first)
    assert keyed_state(spark, store).count() == 7
    later = [(70, " text  3 "), (71, "new"), (None, "new")]
    write(spark, folder, later)
    ingest(landed(spark, folder, schema), store)
    check(decisions(spark.read.parquet(folder), store), first + later)


def test_no_rows(spark):
    folder, store = shared_folder(spark, "landed"), shared_folder(spark, "exact")
    write(spark, folder, [])
    documents = spark.read.parquet(folder)
    ingest(landed(spark, folder, documents.schema), store)
    assert decisions(documents, store).collect() == []
