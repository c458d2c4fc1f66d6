"""Merges in any order, and snapshots that share what a batch leaves alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_tables import arrival, batch

from shelfmark.operators import joins
from shelfmark.plans import snapshots
from shelfmark.plans.tables import empty_tables, id_choice, merge
from shelfmark.session import shared_folder



def content(tables):
    return [sorted(map(str, df.select(sorted(df.columns)).collect())) for df in tables]


EARLY = [arrival("u", 1, "a", "de", files=("old.txt", "b.csv")), arrival("v", 2, "b")]
LATE = [arrival("u", 14, "c", "fr", files=("new.txt",)), arrival("w", 3, "d")]
BETWEEN = [arrival("u", 9, "m", "it", files=("mid.txt",)), arrival("v", 1, "first", "es", files=())]


def test_merges_in_any_order(spark):
    """Nine sorts before fourteen, also as text; the newest arrival's children stay."""
    want = content(merge(empty_tables(spark), batch(spark, *EARLY, *BETWEEN, *LATE)))
    tables = merge(merge(empty_tables(spark), batch(spark, *LATE)), batch(spark, *EARLY, *BETWEEN))
    assert content(tables) == want
    u = next(r for r in tables.projects.collect() if r.project_url == "u")
    assert (u.title, u.language, u.query_string) == ("c", "de", "q1")
    assert [r.file_name for r in tables.files.collect() if r.project_id == u.id] == ["new.txt"]


def test_tables_without_places_are_older(spark):
    first = merge(empty_tables(spark), batch(spark, *LATE))
    bare = first._replace(projects=first.projects.drop("first_seq", "last_seq").selectExpr("*", "CAST(NULL AS STRING) AS first_seq", "CAST(NULL AS STRING) AS last_seq"))
    rows = {r.project_url: r for r in merge(bare, batch(spark, *EARLY)).projects.collect()}
    assert (rows["u"].title, rows["u"].language) == ("a", "fr")


def files_of(df):
    return set(df.inputFiles())


def new_root(spark):
    folder = shared_folder(spark, "tables")
    snapshots.create(spark, folder, buckets=16)
    return folder


def bucket_in(file):
    return int(file.split("bucket=")[1].split("/")[0])


def test_a_small_batch_touches_few_buckets(spark):
    root = new_root(spark)
    many = batch(spark, *[arrival(f"p{i}", 1, f"t{i}") for i in range(100)])
    one = batch(spark, arrival("p7", 2, "new", files=("x.txt",)))
    first = snapshots.merge_batch(spark, root, many, "first")
    before = snapshots.read(spark, root, first)
    second = snapshots.merge_batch(spark, root, one, "second")
    after = snapshots.read(spark, root)
    assert (first.number, second.number) == (1, 2)
    for old, new in zip(before, after):
        # one bucket of each table is written anew, the files of the others are the same
        gone, added = files_of(old) - files_of(new), files_of(new) - files_of(old)
        assert len({bucket_in(f) for f in gone | added}) == 1
        assert len(files_of(old) & files_of(new)) >= 10
    old = merge(empty_tables(spark), many)
    assert content(after) == content(merge(old, one))
    # the version before is still what it was
    assert content(before) == content(old)
    # and a reader of some buckets opens their files only
    some = snapshots.read(spark, root, buckets=[3, 5])
    for table in some:
        assert {bucket_in(f) for f in files_of(table)} <= {3, 5}
    ids = [r.id for r in after.projects.collect()]
    assert some.projects.count() == sum(i % 16 in (3, 5) for i in ids)
    assert joins.orphans(some.files, some.projects).count() == 0


def test_late_rejected_and_repeated_batches(spark):
    root = new_root(spark)
    snapshots.merge_batch(spark, root, batch(spark, *LATE), "late")
    version = snapshots.merge_batch(spark, root, batch(spark, *EARLY, arrival("x", 1, None)), "early")
    want = content(merge(empty_tables(spark), batch(spark, *EARLY, *LATE)))
    assert content(snapshots.read(spark, root)) == want
    assert spark.read.parquet(f"{root}/quarantine/projects").count() == 1
    # a batch of a known name counts once, and half a write is in no version
    assert snapshots.merge_batch(spark, root, batch(spark, *BETWEEN), "late") == version
    snapshots._write(snapshots.read(spark, root).projects, root, "projects", 16, "stray")
    assert content(snapshots.read(spark, root)) == want
    assert snapshots.latest(spark, root) == snapshots.Version(2, 16)


def test_projects_of_one_hash_keep_their_own_children(spark):
    """With ids of two bits at first, in one merge and in two, both give every project
    its own id, and a project keeps its id when it arrives again."""

    def crowded(url, version, attempt):
        choice = id_choice(url, version, attempt)
        return choice if attempt else choice.bitwiseAND(F.lit(3))

    def children(root):
        tables = snapshots.read(spark, root)
        ids = {r.id: r.project_url for r in tables.projects.collect()}
        assert len(ids) == tables.projects.count()
        found = {}
        for r in tables.files.collect():
            found.setdefault(ids[r.project_id], set()).add(r.file_name)
        return {url: i for i, url in ids.items()}, found

    one = [arrival(f"p{i}", 1, f"t{i}", files=(f"{i}.txt", f"{i}.csv")) for i in range(12)]
    two = [arrival(f"p{i}", 2, f"t{i}", files=(f"{i}.pdf",)) for i in range(8, 20)]
    root = new_root(spark)
    snapshots.merge_batch(spark, root, batch(spark, *one), "one", crowded)
    before, found = children(root)
    assert found == {f"p{i}": {f"{i}.txt", f"{i}.csv"} for i in range(12)}
    snapshots.merge_batch(spark, root, batch(spark, *two), "two", crowded)
    after, found = children(root)
    assert {url: after[url] for url in before} == before
    assert found == {f"p{i}": {f"{i}.txt", f"{i}.csv"} if i < 8 else {f"{i}.pdf"} for i in range(20)}


def test_buckets_are_a_power_of_two(spark):
    with pytest.raises(ValueError):
        snapshots.create(spark, shared_folder(spark, "tables"), buckets=12)
